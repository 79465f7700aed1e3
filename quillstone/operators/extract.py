"""Contacts, people and links in page markup."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillstone.functions import tables as t

def all_of(c: Column, pattern: str, group: int) -> Column:
    return F.regexp_extract_all(c, F.lit(pattern), F.lit(group))


def mailto(html: Column) -> Column:
    """Distinct addresses of mailto links, sorted."""
    return F.array_sort(F.array_distinct(all_of(html, t.MAILTO, 1)))


def phones(html: Column) -> Column:
    """Distinct Canadian numbers as area-exchange-number, in order of appearance."""
    parts = F.arrays_zip(all_of(html, t.PAGE_PHONE, 1).alias("a"), all_of(html, t.PAGE_PHONE, 2).alias("b"), all_of(html, t.PAGE_PHONE, 3).alias("c"))
    return F.array_distinct(F.transform(parts, lambda x: F.concat_ws("-", x["a"], x["b"], x["c"])))


def persons(html: Column) -> Column:
    """array<struct<name, role>> of names that stand before a title, without those that hold a stop word."""
    zipped = F.arrays_zip(all_of(html, t.PERSON, 0).alias("whole"), all_of(html, t.PERSON, 1).alias("first"), all_of(html, t.PERSON, 2).alias("last"), all_of(html, t.PERSON, 3).alias("role"))
    stop = F.array(*map(F.lit, t.PERSON_STOP))
    name = lambda x: F.concat_ws(" ", x["first"], x["last"])
    clean = F.filter(zipped, lambda x: ~F.exists(stop, lambda w: F.lower(x["whole"]).contains(w) | F.lower(name(x)).contains(w)))
    return F.transform(clean, lambda x: F.struct(name(x).alias("name"), x["role"].alias("role")))


def _walk(found: object) -> Iterator[dict]:
    todo = [found]
    while todo:
        x = todo.pop()
        if isinstance(x, dict):
            yield x
            todo += list(x.values())[::-1]
        elif isinstance(x, list):
            todo += x[::-1]


def _blocks(blocks: list[str] | None) -> Iterator[object]:
    for b in blocks if blocks is not None else ():
        try:
            yield json.loads(b)
        except (ValueError, RecursionError):
            continue


@F.pandas_udf(T.ArrayType(T.StringType()))
def _ld_emails(blocks: pd.Series) -> pd.Series:
    out = []
    for row in blocks:
        out.append(sorted({v.strip() for found in _blocks(row) for d in _walk(found) for k, v in d.items() if k.lower() == "email" and isinstance(v, str) and "@" in v}))
    return pd.Series(out, dtype=object)


@F.pandas_udf(T.ArrayType(T.StringType()))
def _ld_persons(blocks: pd.Series) -> pd.Series:
    out = []
    for row in blocks:
        people, todo = [], list(_blocks(row))[::-1]
        while todo:
            x = todo.pop()
            if isinstance(x, list):
                todo += x[::-1]
            elif isinstance(x, dict):
                if isinstance(x.get("@type"), str) and x["@type"].lower() == "person":
                    if x.get("name"):  # nothing inside a person is looked at
                        people.append(f"{x['name']}|{x.get('jobTitle', x.get('roleName', ''))}")
                else:
                    todo += list(x.values())[::-1]
        out.append(people)
    return pd.Series(out, dtype=object)


def ld_blocks(html: Column) -> Column:
    """Only these blocks go to Python, where their depth does not matter."""
    return all_of(html, t.LD_JSON, 1)


def ld_emails(html: Column) -> Column:
    return _ld_emails(ld_blocks(html))


def ld_persons(html: Column) -> Column:
    """name|role of every person, outermost first."""
    return _ld_persons(ld_blocks(html))


def page_text(html: Column) -> Column:
    text = F.regexp_replace(html, r"(?is)<(script|style)\b.*?</\1\s*>", " ")
    return F.trim(F.regexp_replace(F.regexp_replace(text, r"<[^>]*>", " "), r"\s+", " "))


def page_emails(html: Column, most: int = 10) -> Column:
    """Addresses in the text, in mailto links and at the top of JSON-LD, without names of assets; sorted, the first ``most``."""
    top = F.transform(ld_blocks(html), lambda b: F.get_json_object(b, "$.email"))
    found = F.array_union(F.array_union(all_of(page_text(html), t.EMAIL_IN_TEXT, 0), mailto(html)), F.array_compact(top))
    asset = lambda e: F.lower(e).rlike("(" + "|".join(s.replace(".", r"\.") for s in t.ASSET_SUFFIXES) + ")$")
    return F.slice(F.array_sort(F.filter(found, lambda e: ~asset(e))), 1, most)


def leadership(html: Column, most: int = 5, titles: str = t.LEADERS) -> Column:
    """The first sentences that name a title, at most 200 characters of each."""
    lines = F.filter(F.split(page_text(html), r"\."), lambda s: s.rlike(titles))
    return F.slice(F.transform(lines, lambda s: F.substring(F.trim(s), 1, 200)), 1, most)


def page_contacts(html: Column, url: Column, most: int = 10) -> Column:
    """struct<phones, emails, name, sentences, leader_page> of a page: numbers in the text, tel links and JSON-LD, as they stand there.

    Lists are distinct and sorted, the first ``most``. The name is that of the last JSON-LD block with one; ``leader_page`` tells by the address. Null pages hold nothing.
    """
    blocks = ld_blocks(html)
    top = lambda k: F.array_compact(F.transform(blocks, lambda b: F.get_json_object(b, f"$.{k}")))
    tel = F.transform(all_of(html, r"(?i)<a\b[^>]*?\bhref=[\"'](?-i:tel:)([^\"']*)[\"']", 1), lambda x: F.trim(x))
    numbers = F.array_union(F.array_union(F.transform(all_of(page_text(html), t.PROBED_PHONE, 0), lambda x: F.trim(x)), tel), top("telephone"))
    listed = F.slice(F.array_sort(F.filter(numbers, lambda x: x != "")), 1, most)
    leads = F.exists(F.array(*map(F.lit, t.LEADER_PAGES)), lambda w: F.lower(url).contains(w))
    return F.struct(listed.alias("phones"), page_emails(html, most).alias("emails"), F.try_element_at(top("name"), F.lit(-1)).alias("name"), leadership(html, titles=t.PROBED_TITLES).alias("sentences"), F.coalesce(leads, F.lit(False)).alias("leader_page"))


def link_domains(html: Column, excluded: tuple[str, ...] = (), most: int = 8) -> Column:
    """scheme://host of the links, redirects unwrapped, in order, distinct, the first ``most``."""
    links = all_of(html, r"(?i)<a\b[^>]*?\bhref=[\"']([^\"']*)[\"']", 1)
    wrapped = lambda h: F.regexp_extract(F.regexp_replace(h, "&amp;", "&"), r"[?&](?:uddg|u)=([^&]*)", 1)
    plain = F.transform(links, lambda h: F.when(h.contains("/l/?uddg=") | h.contains("/l/?kh="), F.try_url_decode(wrapped(h))).when(h.startswith("http"), h))
    hosts = F.transform(plain, lambda u: F.regexp_extract(u, r"^(https?://[^/?#]+)", 1))
    names = lambda u: F.regexp_replace(F.lower(F.regexp_extract(u, r"^https?://([^/?#]+)", 1)), r"^www\.", "")
    good = F.filter(hosts, lambda u: u.isNotNull() & names(u).contains(".") & ~F.exists(F.array(*map(F.lit, excluded)).cast("array<string>"), lambda x: names(u).contains(x)))
    return F.slice(F.array_distinct(good), 1, most)


def verify_domain(text: Column, name: Column, city: Column, province: Column) -> Column:
    """VERIFIED: two significant words of the name and the city or province in the text; PLAUSIBLE: one word."""
    words = F.filter(F.split(F.lower(name), r"\W+"), lambda w: (F.length(w) > 2) & ~w.isin(*t.NAME_NOISE))
    hits = F.size(F.filter(words, lambda w: F.lower(text).contains(w)))
    place = F.lower(text).contains(F.lower(city)) | F.lower(text).contains(F.lower(province))
    return F.when((hits >= 2) & place, "VERIFIED").when(hits >= 1, "PLAUSIBLE").otherwise("NOT_VERIFIED")
