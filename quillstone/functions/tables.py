"""Fixed values of the record vocabulary: they decide results and are used as they are."""

# --- fixed values: names -------------------------------------------------------------------------
NAME_WORDS = {"LTD": "LIMITED", "INC": "INCORPORATED", "CORP": "CORPORATION", "CO": "COMPANY", "ST": "SAINT"}
NAME_PUNCTUATION = r"""[.,!?;:"#@$%^&*(){}<>\[\]|\\~/`]"""

# --- fixed values: streets and units -------------------------------------------------------------
STREET_TYPES = {
    "ST": "STREET", "AVE": "AVENUE", "AV": "AVENUE", "BLVD": "BOULEVARD", "BOUL": "BOULEVARD", "DR": "DRIVE", "RD": "ROAD", "PL": "PLACE",
    "CRT": "COURT", "CT": "COURT", "CRES": "CRESCENT", "CR": "CRESCENT", "LN": "LANE", "HWY": "HIGHWAY", "PKY": "PARKWAY", "PKWY": "PARKWAY",
    "SQ": "SQUARE", "TER": "TERRACE", "TERR": "TERRACE", "TRL": "TRAIL", "CIR": "CIRCLE", "CIRC": "CIRCLE", "GT": "GATE", "GRV": "GROVE",
    "PK": "PARK", "GLN": "GLEN", "GDNS": "GARDENS", "GDN": "GARDEN", "WAY": "WAY", "PT": "POINT", "VISTA": "VISTA", "PROMENADE": "PROMENADE",
}
UNIT_LABELS = {"SUITE": "SUITE", "STE": "SUITE", "UNIT": "UNIT", "APT": "APT", "APARTMENT": "APT", "RM": "ROOM", "ROOM": "ROOM", "BLDG": "BLDG", "BUILDING": "BLDG"}

# --- fixed values: provinces and postal codes ----------------------------------------------------
PROVINCES = ("AB", "BC", "MB", "NB", "NL", "NS", "NT", "NU", "ON", "PE", "QC", "SK", "YT")
PROVINCE_NAMES = {
    "ALBERTA": "AB", "BRITISH COLUMBIA": "BC", "MANITOBA": "MB", "NEW BRUNSWICK": "NB", "NEWFOUNDLAND AND LABRADOR": "NL", "NOVA SCOTIA": "NS", "NORTHWEST TERRITORIES": "NT",
    "NUNAVUT": "NU", "ONTARIO": "ON", "PRINCE EDWARD ISLAND": "PE", "QUEBEC": "QC", "SASKATCHEWAN": "SK", "YUKON": "YT",
}
POSTAL = r"^[A-CEGHJ-NPR-TVXY][0-9][A-Z][0-9][A-Z][0-9]$"

# --- fixed values: absent-value words ------------------------------------------------------------
NO_CONTACT = ("n/a", "na", "none", "null", "unknown", "-", "--", "n.a.", "")
NO_NUMBER = ("n/a", "na", "none", "null", "unknown", "")
NO_DATE = ("n/a", "na", "none", "null", "unknown", "-", "", "0000-00-00")

# --- fixed values: Canadian area codes (public numbering plan), and toll-free ones ---------------
AREA_CODES = (
    "204", "226", "236", "249", "250", "257", "263", "289", "306", "343", "354", "365", "367", "368", "382", "387", "403", "416", "418", "428", "431", "437", "438", "450", "460", "468", "474",
    "506", "514", "519", "548", "579", "581", "584", "587", "604", "613", "639", "647", "672", "683", "705", "709", "742", "753", "778", "780", "782", "807", "819", "825", "867", "873", "879", "902", "905",
)
TOLL_FREE = ("800", "822", "833", "844", "855", "866", "877", "888")

EMAIL = r"^[a-z0-9.!#$%&'*+/=?^_`{|}~-]+@[a-z0-9]([a-z0-9-]{0,61}[a-z0-9])?(\.[a-z0-9]([a-z0-9-]{0,61}[a-z0-9])?)+$"

# --- fixed values: status words, by source and in general ----------------------------------------
SOURCE_STATUS = {
    "calgary": {"ACTIVE": "ACTIVE", "INACTIVE": "INACTIVE", "EXPIRED": "INACTIVE", "CANCELLED": "INACTIVE", "SUSPENDED": "SUSPENDED", "PENDING": "PENDING"},
    "edmonton": {"ISSUED": "ACTIVE", "ACTIVE": "ACTIVE", "CANCELLED": "INACTIVE", "EXPIRED": "INACTIVE"},
    "vancouver": {"ISSUED": "ACTIVE", "GONE OUT OF BUSINESS": "INACTIVE", "CANCELLED": "INACTIVE", "SUSPENDED": "SUSPENDED", "PENDING": "PENDING", "IN PROGRESS": "PENDING"},
    "winnipeg": {"ACTIVE": "ACTIVE", "CLOSED (L)": "INACTIVE", "CLOSED": "INACTIVE", "SUSPENDED": "SUSPENDED", "CANCELLED": "INACTIVE"},
    "corporations_canada_csv": {"ACTIVE": "ACTIVE", "DISSOLVED": "DISSOLVED", "INACTIVE": "INACTIVE", "AMALGAMATED": "INACTIVE", "CANCELLED": "INACTIVE", "DEFAULTED": "SUSPENDED"},
    "saskatoon_all_biz": {"ACTIVE": "ACTIVE", "INACTIVE": "INACTIVE"},
    "saskatoon_new_biz": {"ACTIVE": "ACTIVE"},
    "bc_indigenous": {"ACTIVE": "ACTIVE", "INACTIVE": "INACTIVE"},
    "ontario_select_licence": {"ACTIVE": "ACTIVE", "INACTIVE": "INACTIVE", "EXPIRED": "INACTIVE", "REVOKED": "SUSPENDED"},
}
STATUS = {
    "ACTIVE": "ACTIVE", "OPEN": "ACTIVE", "ISSUED": "ACTIVE", "VALID": "ACTIVE", "CURRENT": "ACTIVE", "INACTIVE": "INACTIVE", "CLOSED": "INACTIVE", "EXPIRED": "INACTIVE", "CANCELLED": "INACTIVE",
    "REVOKED": "INACTIVE", "GONE OUT OF BUSINESS": "INACTIVE", "TERMINATED": "INACTIVE", "AMALGAMATED": "INACTIVE", "DEFAULTED": "SUSPENDED", "SUSPENDED": "SUSPENDED", "DISSOLVED": "DISSOLVED",
    "PENDING": "PENDING", "IN PROGRESS": "PENDING", "PENDING REVIEW": "PENDING",
}
CREDENTIAL_STATUS = {"ACT": "ACTIVE", "HIS": "INACTIVE", "DIS": "DISSOLVED", "SUS": "SUSPENDED", "LIQ": "INACTIVE"}
NON_ACTIVE = ("closed (l)", "expired", "revoked", "suspended", "cancelled")

# --- fixed values: employee buckets (low, high, label) and the ambiguous range -------------------
BUCKETS = ((1, 4, "1-4"), (5, 9, "5-9"), (10, 19, "10-19"), (20, 49, "20-49"), (50, 99, "50-99"), (100, 199, "100-199"), (200, 499, "200-499"), (500, 999, "500-999"), (1000, None, "1000+"))
AMBIGUOUS = (55, 99)

# --- fixed values: industry sectors --------------------------------------------------------------
SECTORS = ("11", "21", "22", "23", "31", "32", "33", "41", "44", "45", "48", "49", "51", "52", "53", "54", "55", "56", "61", "62", "71", "72", "81", "91")

# --- fixed values: date forms, tried in this order -----------------------------------------------
DATES = (
    "yyyy-M-d'T'H:m:s.SSSSSSXXX", "yyyy-M-d'T'H:m:s.SSSSSSXX", "yyyy-M-d'T'H:m:sXXX", "yyyy-M-d'T'H:m:sXX", "yyyy-M-d'T'H:m:s", "yyyy-M-d H:m:s", "yyyy-M-d", "d/M/yyyy H:m:s", "d/M/yyyy",
    "M/d/yyyy H:m:s", "M/d/yyyy", "yyyyMMdd", "MMMM d, yyyy", "MMM d, yyyy", "d MMMM yyyy", "d MMM yyyy",
)

# --- fixed values: the payload keys of each field, tried in this order ---------------------------
ALIASES = {
    "legal_name": ("corporate_name_form_1", "legal_name", "company_name", "name", "business_name", "businessname", "canonical_name"),
    "trade_name": ("tradename", "trade_name", "dba", "operating_name", "businesstradename", "business_trade_name"),
    "street": ("address", "address_line1", "street", "street_address", "registered_office", "fulladdress", "address1", "adresse_travaux"),
    "city": ("city", "municipality", "town", "community", "neighbourhood"),
    "province": ("province", "prov", "province_code", "region"),
    "postal_code": ("postal_code", "postalcode", "postal", "zip"),
    "phone": ("phone", "phone_number", "telephone", "tel", "contact_phone", "business_phone"),
    "email": ("email", "email_address", "contact_email", "business_email"),
    "website": ("website", "url", "web", "website_url", "homepage"),
    "status": ("status", "jobstatusdesc", "licence_status", "corp_status", "business_status", "active_status"),
    "employees": ("numberofemployees", "employee_count", "employees", "employee_range", "num_employees", "no_of_employees"),
    "naics": ("naics", "naics_code", "scian", "naics_sub_sector", "industry_code", "licence_type_naics"),
    "issued_date": ("first_iss_dt", "issueddate", "originalissuedate", "issue_date", "original_issue_date", "most_recent_issue_date", "date_delivrance"),
    "expiry_date": ("exp_dt", "expiry_date", "expiration_date", "licence_expiry"),
    "incorporation_date": ("incorporation_date", "anniversary_date", "registration_date", "incorporated_date"),
}
#: Keys that sources land with and the lists above leave out; tried after them.
MORE_ALIASES = {
    "legal_name": ("corp_nme", "name of corporation", "business name", "nom", "nom_etablissement"),
    "street": ("business_address", "adresse", "adresse_complete", "registered office"),
    "city": ("city/town",),
    "province": ("province/territory", "territory_province"),
}
CORP_NUMBER_KEYS = ("corp_number", "corp_no", "corp_num", "corporation_number", "corporation number")
BN_KEYS = ("business_number_bn", "bn", "business_number")
EXTERNAL_ID_KEYS = ("externalid", "external_id")
EXTERNAL_ID_SOURCE = "edmonton"
#: Read as names, yet also passed through among the unknown keys.
LEAKED = ("businessname", "businesstradename", "business_trade_name")
PERMITS = "quebec_city_permits"
IDENTITY_KEYS = ("corp_number", "corp_no", "business_number_bn", "bn", "business_number")

# --- fixed values: events ------------------------------------------------------------------------
TYPED_EVENTS = (
    "FEDERAL_INCORPORATION", "PROVINCIAL_REGISTRATION", "MUNICIPAL_LICENCE_FIRST_ISSUE", "MUNICIPAL_LICENCE_RENEWAL", "MUNICIPAL_PERMIT_ISSUED", "LICENCE_STATUS_CHANGE", "REGISTRY_FILING", "NNI_REGISTRATION_RENEWAL",
)
FIRST_ISSUE = "MUNICIPAL_LICENCE_FIRST_ISSUE"
NAME_FIELDS = ("legal_name", "trade_name")
LOCATION_FIELDS = ("address", "city", "province", "postal_code")
#: Payload keys that date, name and number an event where its normalised fields do not, tried in this order.
EVENT_DATE_KEYS = ("effective date", "effective_date", "incorporation_date", "issue_date", "registration_date")
EVENT_NAME_KEYS = ("name of corporation", "company_name", "business_name", "name")
PERMIT_KEYS = ("NUMERO_PERMIS", "numero_permis", "permit_number")

# --- fixed values: scores ------------------------------------------------------------------------
CLASS_WEIGHT = {"A": 100, "B": 70, "C": 85, "D": 0}
PRIMARY_ROLES = ("PRIMARY_CONTACT", "GENERAL_MANAGER", "PRESIDENT")
RECENCY = ((30, 100), (90, 80), (180, 60), (365, 40), (730, 20))
COMPOSITE = {"identity": 0.25, "address": 0.20, "phone": 0.15, "email": 0.10, "contact": 0.10, "recency": 0.10, "employee": 0.05, "industry": 0.05}

# --- fixed values: extraction from pages ---------------------------------------------------------
PERSON_STOP = (
    "googletag", "google tag", "end google", "gtag", "analytics", "javascript", "function", "return", "undefined", "null", "true", "false", "window", "document", "var ", "let ", "const ", "jquery",
    "bootstrap", "webpack", "module", "export", "import", "cookie", "privacy", "terms", "copyright", "all rights", "site map", "site by", "powered by", "skip to", "menu", "home page", "contact us",
    "about us", "our team", "our staff",
)
PERSON = (
    r"(?i)\b([A-Z][a-z]{1,20})\s+([A-Z][a-z]{1,25})\b[\s,\-|:]+\b("
    r"CEO|President|Founder|Owner|Director|Manager|Partner|Principal|Associate|Consultant|Coordinator|Administrator|General\s+Manager|Operations\s+Manager|Office\s+Manager|IT\s+(?:Manager|Director)|Procurement|Controller"
    r")\b"
)
LEADERS = r"(?i)\b(CEO|President|Founder|Owner|Director|Principal|Partner|Chief)\b"
LD_JSON = r"(?is)<script[^>]+type=[\"']application/ld\+json[\"'][^>]*>(.*?)</script>"
EMAIL_IN_TEXT = r"[a-zA-Z0-9._%+\-]+@[a-zA-Z0-9.\-]+\.[a-zA-Z]{2,}"
NAME_NOISE = ("inc", "ltd", "ltee", "the", "and", "de", "et", "co", "corp", "company")
ASSET_SUFFIXES = (".png", ".jpg", ".gif", ".css")
PAGE_PHONE = r"(?<!\d)(?:\+?1[\s\-.]?)?\(?([2-9]\d{2})\)?[\s\-.]?([2-9]\d{2})[\s\-.]?(\d{4})(?!\d)"
PROBED_PHONE = r"(?<!\d)(?:\+?1[\s\-.]?)?\(?\d{3}\)?[\s\-.]?\d{3}[\s\-.]?\d{4}(?!\d)"
PROBED_TITLES = (
    r"(?i)\b(owner|founder|co-founder|president|vice president|vp|general manager|gm|operations manager|office manager|it manager|it director|director of it|technology manager|"
    r"procurement manager|purchasing manager|facilities manager|controller|coo|cto|cio|chief operating|chief technology|chief information)\b"
)
LEADER_PAGES = ("/team", "/leadership", "/management", "/about", "/people")
MAILTO = r"(?i)mailto:([a-zA-Z0-9._%+\-]+@[a-zA-Z0-9.\-]+\.[a-zA-Z]{2,})"
INCORPORATION_HEADERS = ("corporation number", "name of corporation", "registered office", "effective date")
EXCLUDED_DOMAINS = (
    "linkedin.com", "facebook.com", "twitter.com", "instagram.com", "yelp.com", "yellowpages.ca", "canada411.ca", "opencorporates.com", "wikipedia.org", "bbb.org", "google.com", "bing.com",
    "duckduckgo.com", "youtube.com", "tiktok.com", "pinterest.com", "yelp.ca", "foursquare.com", "tripadvisor.com", "indeed.com", "glassdoor.com", "canadabusiness.ca", "ic.gc.ca", "canada.ca", "gov.bc.ca",
)

# --- fixed values: headers of landed files, in lower case, and the payload keys they become -------
_ONTARIO_PLANT = {
    "name": "name", "plant name": "name", "business name": "name", "address": "address", "street address": "address", "city": "city", "postal code": "postal_code", "postal": "postal_code", "telephone": "phone",
    "phone": "phone", "phone number": "phone", "licence number": "licence_number", "license number": "licence_number", "licence no": "licence_number", "licence #": "licence_number",
}
_ONTARIO_REGISTRANT = {
    "name": "name", "registrant name": "name", "business name": "name", "address": "address", "street address": "address", "city": "city", "province": "province", "postal code": "postal_code", "postal": "postal_code",
    "phone": "phone", "telephone": "phone",
}
HEADERS = {
    "bc_indigenous": {
        "business name": "name", "name": "name", "company name": "name", "phone": "phone", "telephone": "phone", "phone number": "phone", "email": "email", "email address": "email", "website": "website",
        "web site": "website", "url": "website", "primary contact": "primary_contact", "contact name": "primary_contact", "contact": "primary_contact", "employee range": "employee_range",
        "number of employees": "employee_range", "employees": "employee_range", "industry sector": "industry_sector", "industry": "industry_sector", "sector": "industry_sector", "category": "industry_sector",
        "city": "city", "community": "city", "location": "city", "province": "province", "postal code": "postal_code", "postal": "postal_code", "address": "address", "street address": "address", "mailing address": "address",
    },
    "ontario_dairy_distributors": {
        "name": "name", "business name": "name", "distributor name": "name", "address": "address", "street": "address", "street address": "address", "city": "city", "postal code": "postal_code", "postal": "postal_code",
        "telephone": "phone", "phone": "phone", "phone number": "phone", "licence number": "licence_number", "license number": "licence_number", "licence no": "licence_number", "licence #": "licence_number", "province": "province",
    },
    "ontario_dairy_plants": _ONTARIO_PLANT | {"province": "province"},
    "ontario_meat_plants": _ONTARIO_PLANT | {"latitude": "latitude", "longitude": "longitude", "animal class": "animal_class", "class": "animal_class", "province": "province"},
    "ontario_tobacco": _ONTARIO_REGISTRANT | {"modification date": "modification_date", "date modified": "modification_date", "modified": "modification_date", "registration number": "licence_number", "registrant number": "licence_number"},
    "ontario_fuel": _ONTARIO_REGISTRANT | {"authorization number": "licence_number", "registration number": "licence_number", "registrant number": "licence_number", "authorization type": "authorization_type", "type": "authorization_type"},
    "ontario_csbif": {
        "name": "name", "fund name": "name", "business name": "name", "address": "address", "street address": "address", "city": "city", "province": "province", "postal code": "postal_code", "postal": "postal_code",
        "phone": "phone", "telephone": "phone", "contact": "contact_name", "contact name": "contact_name", "primary contact": "contact_name", "email": "email", "website": "website", "registration number": "licence_number",
        "registration #": "licence_number", "registration date": "registration_date", "date registered": "registration_date", "status": "licence_status",
    },
    "nni": {
        "business name": "business_name", "company name": "business_name", "business number": "business_number", "registration number": "business_number", "business type": "business_type", "type": "business_type",
        "street address": "street_address", "address": "street_address", "city/community": "community", "community": "community", "city": "community", "location": "community", "postal code": "postal_code",
        "postal": "postal_code", "phone": "phone", "telephone": "phone", "phone number": "phone", "contact name": "contact_name", "primary contact": "contact_name", "contact": "contact_name",
        "no. of employees": "employee_count", "no of employees": "employee_count", "number of employees": "employee_count", "employees": "employee_count", "email": "email", "email address": "email",
        "website": "website", "web site": "website", "territory/province": "territory_province", "territory": "territory_province", "province": "territory_province", "status": "business_status",
        "business status": "business_status", "effective date": "effective_date", "sectors": "sectors", "goods": "goods", "services": "services",
    },
}
#: The columns kept of a select licence file, and those of them in which a word for absent counts as absent.
SELECT_LICENCE = {
    "Legal Name": "legal_name", "Operating name": "operating_name", "Address": "address", "City": "city", "Province": "province", "Postal code": "postal_code", "Country": "country", "Telephone": "phone",
    "Website": "website", "Email": "email", "Licence type": "licence_type", "Licence number": "licence_number", "Licence status": "licence_status", "Expiry date": "expiry_date",
}
SELECT_LICENCE_CLEANED = ("operating_name", "postal_code", "country", "phone", "website", "email", "expiry_date")
SELECT_LICENCE_ABSENT = ("n/a", "na", "none", "", "null", "-")
REGULATED_ABSENT = ("n/a", "na", "none", "", "null", "-", "not available")
PROFILE_LISTS = ("sectors", "goods", "services")
