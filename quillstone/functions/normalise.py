"""Field normalisers: column in, column (or struct) out, all inside Catalyst."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from quillstone.functions import tables as t


def let(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once: the optimiser does not copy what a lambda binds into each place that reads it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def lookup(pairs: dict[str, str], key: Column) -> Column:
    return F.create_map(*[F.lit(x) for kv in pairs.items() for x in kv])[key]


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def stripped(c: Column) -> Column:
    """Without white space at both ends."""
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def first_nonempty(*values: Column) -> Column:
    return F.coalesce(*(blank_to_null(stripped(v)) for v in values))


def field(payload: Column, name: str, compat: bool = False) -> Column:
    """The first non-empty payload value among a field's aliases; ``compat``: without those that the surveyed lists leave out."""
    return first_nonempty(*(payload[k] for k in (*t.ALIASES[name], *(() if compat else t.MORE_ALIASES.get(name, ())))))


def present(c: Column, absent: tuple[str, ...]) -> Column:
    """The stripped value, null if it is one of the words for absent."""
    return let(stripped(c), lambda s: F.when(~F.lower(s).isin(*absent), s))


def swapped(s: Column, pattern: str, to) -> Column:
    """``s`` with every match of ``pattern`` replaced by ``to(groups)``, an array of the groups 1 and 2 (if it has two) of each match."""
    two = pattern.count("(") - pattern.count("(?") > 1
    groups = [F.regexp_extract_all(s, F.lit(pattern), F.lit(g)).alias(f"g{g}") for g in ((1, 2) if two else (1,))]
    parts = F.arrays_zip(F.split(s, pattern, -1).alias("gap"), *groups)
    return F.array_join(F.transform(parts, lambda x: F.concat(x["gap"], F.coalesce(to(x), F.lit("")))), "")


def name(c: Column) -> Column:
    s = F.upper(stripped(c))
    s = reduce(lambda x, kv: F.regexp_replace(x, rf"\b{kv[0]}\b", kv[1]), t.NAME_WORDS.items(), s)
    s = F.regexp_replace(F.lower(s), t.NAME_PUNCTUATION, " ")
    return blank_to_null(F.trim(F.regexp_replace(s, r"\s+", " ")))


def postal(c: Column) -> Column:
    """struct<code, valid>; over-long invalid codes are dropped, short ones kept as they came."""
    def coded(x):
        good = x["packed"].rlike(t.POSTAL)
        code = F.when(good, F.concat(F.substring(x["packed"], 1, 3), F.lit(" "), F.substring(x["packed"], 4, 3))).when(F.length(x["s"]) <= 7, x["s"])
        return F.struct(code.alias("code"), F.when(x["s"].isNotNull(), good).alias("valid"))

    return let(blank_to_null(stripped(c)), lambda s: let(F.struct(s.alias("s"), F.regexp_replace(F.upper(s), "[- ]", "").alias("packed")), coded))


def street(c: Column) -> Column:
    # No replacement is a key of its own table, so one pass does what one after the other would.
    types = rf"(?i)\b({'|'.join(t.STREET_TYPES)})\b"
    # A unit label takes the word after it, joined on or not; labels come longest first where one begins another.
    unit = rf"(?i)\b({'|'.join(sorted(t.UNIT_LABELS, key=len, reverse=True))})\s*[#:]?\s*(\w+)\b"
    named = lambda s: swapped(s, types, lambda x: lookup(t.STREET_TYPES, F.upper(x["g1"])))
    whole = lambda s: swapped(s, unit, lambda x: F.concat(lookup(t.UNIT_LABELS, F.upper(x["g1"])), F.lit(" "), F.upper(x["g2"])))
    return blank_to_null(F.trim(F.regexp_replace(let(let(blank_to_null(stripped(c)), named), whole), r"\s+", " ")))


def title(c: Column) -> Column:
    """Every letter after a non-letter in upper case, the others in lower."""
    words = F.regexp_extract_all(c, F.lit(r"([^\p{L}]*)(\p{L}*)"), F.lit(0))
    return F.array_join(F.transform(words, lambda w: F.concat(F.regexp_extract(w, r"^[^\p{L}]*", 0), F.initcap(F.lower(F.regexp_extract(w, r"\p{L}*$", 0))))), "")


def city(c: Column) -> Column:
    return title(blank_to_null(stripped(c)))


def province(c: Column) -> Column:
    named = let(F.upper(stripped(c)), lambda s: F.coalesce(lookup(t.PROVINCE_NAMES, s), s))
    return let(named, lambda code: F.when(code.isin(*t.PROVINCES), code))


def address(street_c: Column, city_c: Column, province_c: Column, postal_c: Column) -> Column:
    def put_together(x):
        s, code = x["street"], x["postal"]
        line1, line2 = F.trim(F.substring_index(s, ",", 1)), F.when(F.instr(s, ",") > 0, F.trim(F.substring(s, F.instr(s, ",") + 1, F.length(s))))
        whole = F.concat_ws(", ", blank_to_null(line1), blank_to_null(line2), x["city"], x["province"], code["code"])
        return F.struct(
            blank_to_null(whole).alias("normalised_address"), x["raw"].alias("raw_address"), line1.alias("address_line1"), line2.alias("address_line2"),
            x["city"].alias("city"), x["province"].alias("province"), code["code"].alias("postal_code"), code["valid"].alias("postal_valid"),
        )

    def normal(r):
        raw = F.concat_ws(", ", *(F.when(stripped(r[c]) != "", r[c]) for c in ("street", "city", "province", "postal")))
        return F.struct(street(r["street"]).alias("street"), city(r["city"]).alias("city"), province(r["province"]).alias("province"), postal(r["postal"]).alias("postal"), blank_to_null(raw).alias("raw"))

    return let(let(F.struct(street_c.alias("street"), city_c.alias("city"), province_c.alias("province"), postal_c.alias("postal")), normal), put_together)


def phone(c: Column) -> Column:
    """struct<raw, e164, valid>: ten digits of a Canadian area code, or toll-free; an extension is left off."""
    def ten(x):
        digits = F.regexp_replace(x["main"], r"\D", "")
        number = F.when((F.length(digits) == 11) & digits.startswith("1"), F.substring(digits, 2, 10)).when((F.length(digits) == 10) & ~x["main"].startswith("+"), digits)
        return F.struct(x["raw"].alias("raw"), x["main"].alias("main"), number.alias("ten"))

    def judged(x):
        good = x["ten"].rlike(r"^[2-9]\d{2}[2-9]\d{6}$") & F.substring(x["ten"], 1, 3).isin(*t.AREA_CODES, *t.TOLL_FREE) & ~x["main"].rlike("[A-Za-z]")
        good = F.when(x["raw"].isNotNull(), F.coalesce(good, F.lit(False)))
        return F.struct(x["raw"].alias("raw"), F.when(good, F.concat(F.lit("+1"), x["ten"])).alias("e164"), good.alias("valid"))

    main = lambda raw: F.struct(raw.alias("raw"), F.regexp_replace(raw, r"(?i)\s*(?:;?ext\.?|x|#)\s*=?\s*\d{1,7}$", "").alias("main"))
    return let(let(let(present(c, t.NO_CONTACT), main), ten), judged)


def email(c: Column) -> Column:
    def judged(raw):
        good = F.lower(raw).rlike(t.EMAIL)
        return F.struct(raw.alias("raw"), F.when(good, F.lower(raw)).alias("email"), good.alias("valid"))

    return let(present(c, t.NO_CONTACT), judged)


def domain(c: Column) -> Column:
    def hosted(raw):
        whole = F.when(F.instr(raw, "://") > 0, raw).otherwise(F.concat(F.lit("http://"), raw))
        host = F.lower(F.regexp_extract(whole, r"^[^:]*://([^/?#:]*)", 1))
        return F.struct(raw.alias("raw"), F.regexp_replace(host, r"^www[0-9]*\.", "").alias("host"))

    def judged(x):
        good = x["host"].contains(".")
        return F.struct(x["raw"].alias("raw"), F.when(good, x["host"]).alias("domain"), F.when(x["raw"].isNotNull(), good).alias("valid"))

    return let(let(present(c, t.NO_CONTACT), hosted), judged)


def status(c: Column, source: Column) -> Column:
    own = {f"{k}|{w}": v for k, words in t.SOURCE_STATUS.items() for w, v in words.items()}
    mapped = lambda s: F.coalesce(lookup(own, F.concat(F.lower(F.coalesce(source, F.lit(""))), F.lit("|"), s)), lookup(t.STATUS, s), F.lit("UNKNOWN"))
    return let(F.upper(stripped(c)), mapped)


def bucket(low: Column, high: Column) -> Column:
    """The size band of the middle of a range; an open range is always 500+."""
    middle = (low + high) / 2
    out = F.when(low.isNotNull() & high.isNull(), "500+")
    for a, b, label in t.BUCKETS:
        out = out.when((middle >= a) & (F.lit(True) if b is None else middle <= b), label)
    return out


def employee(c: Column) -> Column:
    one, plus, span = r"^(\d+)(\.\d+)?$", r"(?i)^(\d+)\s*(?:plus|\+)$", r"(?i)^(\d+)\s*(?:to|-)\s*(\d+)$"

    def ranged(raw):
        number = lambda p, g: F.regexp_extract(raw, p, g).try_cast("int")
        low = F.when(raw.rlike(one), number(one, 1)).when(raw.rlike(plus), number(plus, 1)).when(raw.rlike(span), number(span, 1))
        high = F.when(raw.rlike(one), number(one, 1)).when(raw.rlike(span), number(span, 2))
        return F.struct(raw.alias("raw"), low.alias("low"), high.alias("high"))

    def judged(x):
        raw, low, high = x["raw"], x["low"], x["high"]
        return F.struct(
            raw.alias("raw"), low.alias("low"), high.alias("high"), bucket(low, high).alias("bucket"), F.coalesce(raw.rlike(one), F.lit(False)).alias("exact"),
            F.when(raw.rlike(span) & (low == t.AMBIGUOUS[0]) & (high == t.AMBIGUOUS[1]), "EMPLOYEE_RANGE_AMBIGUITY").alias("flag"),
        )

    return let(let(present(c, t.NO_NUMBER), ranged), judged)


def naics(c: Column) -> Column:
    def judged(source):
        two = F.substring(F.regexp_replace(source, r"\D", ""), 1, 2)
        return F.struct(source.alias("source"), F.when(two.isin(*t.SECTORS), two).alias("sector"))

    return let(blank_to_null(stripped(c)), judged)


def date(c: Column) -> Column:
    """UTC timestamp by the first form that fits; day before month where both would do."""
    return let(present(c, t.NO_DATE), lambda s: F.coalesce(*(F.try_to_timestamp(s, F.lit(f)) for f in t.DATES)))


def iso(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'+00:00'")


def extra(payload: Column, source: Column, compat: bool = False) -> Column:
    """The payload's keys that no field reads; permits get their event type."""
    lists = (*t.ALIASES.values(), *(() if compat else t.MORE_ALIASES.values()))
    known = [k for keys in lists for k in keys if k not in t.LEAKED]
    rest = F.map_filter(payload, lambda k, v: ~k.isin(*known) & v.isNotNull() & (v != ""))
    tag = F.create_map(F.lit("event_type"), F.lit("MUNICIPAL_PERMIT_ISSUED"))
    tagged = F.map_concat(F.map_filter(rest, lambda k, v: k != "event_type"), tag)
    out = F.when(source == t.PERMITS, tagged).otherwise(rest)
    return F.when(F.size(out) > 0, out)
