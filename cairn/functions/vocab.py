"""Fixed vocabularies and the Column functions that normalise to them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .trims import rstrip

# File extensions by kind of resource.
DOCUMENT_EXTENSIONS = (".pdf", ".doc", ".docx", ".ppt", ".pptx", ".xls", ".xlsx", ".csv")
STATIC_EXTENSIONS = (".css", ".js", ".png", ".jpg", ".jpeg", ".gif", ".svg", ".webp", ".ico", ".mp4", ".mov")
# Words that decide a page's class and score.
PRODUCT_TOKENS = ("product", "products", "catalog", "datasheet", "spec", "specs", "solution", "solutions", "capabilities")
COMPLIANCE_TOKENS = ("compliance", "certification", "certifications", "quality", "itar", "ndaa", "blue-uas", "as9100")
ABOUT_TOKENS = ("about", "company", "team", "leadership", "contact", "location", "headquarters", "facility")
LOW_VALUE_TOKENS = ("blog", "news", "press", "career", "careers", "jobs", "event", "webinar")
NEWS_TOKENS = ("blog", "news", "press", "media", "article", "announcement", "announces", "partnership", "partner", "award", "mou", "sign", "teaming")
CAREER_TOKENS = ("career", "careers", "job", "jobs", "recruiting", "life-at", "join-us")
CONTACT_TOKENS = ("contact", "locations", "headquarters")
LEGAL_TOKENS = ("terms", "terms-of-service", "privacy", "privacy-policy", "legal", "cookies", "cookie", "gdpr", "data-protection")
COMPANY_SEGMENTS = ("about", "company", "team", "leadership", "executive", "executives", "facility", "facilities")
GOVERNMENT_TOKENS = ("security", "procurement", "government")
CLEAR_PRODUCT_TOKENS = ("product", "products", "platform", "platforms", "v-bat", "hivemind", "nova", "ai-pilot")
PRODUCT_SLUGS = ("products", "v-bat", "v-bat-teams", "hivemind", "hivemind-solutions", "hivemind-enterprise", "ai-pilot")
CAPABILITY_TOKENS = ("autonomy", "autonomous", "mission", "capability", "capabilities", "technology", "solution", "solutions", "air", "ground", "systems", "ai")
LEAF_PRODUCT_TOKENS = ("datasheet", "spec", "manual", "catalog")
PAGE_CLASSES = ("homepage", "product", "capability", "company", "contact", "compliance", "news", "career", "other")
# Pages kept of each class, in the order above, by profile; then pages, paid calls and documents in all.
PROFILE_BUDGETS = {
    "quick_evidence": (1, 3, 2, 2, 1, 1, 1, 0, 0),
    "serious_vendor": (1, 18, 14, 7, 2, 5, 3, 0, 0),
    "full_audit": (1, 160, 120, 35, 10, 35, 100, 5, 34),
}
PROFILE_LIMITS = {"quick_evidence": (8, 10), "serious_vendor": (50, 80), "full_audit": (500, 650)}
# Search terms by product category.
CATEGORY_QUERY_TERMS = {
    "communications": ("datalink", "radio", "mesh communications"),
    "flight_vehicle_control": ("autopilot", "flight controller", "avionics"),
    "isr_payloads": ("EO IR payload", "gimbal", "imaging payload"),
    "power_systems": ("battery", "power system", "charger"),
    "propulsion_mechanical": ("motor", "propeller", "propulsion"),
    "propulsion_electronics": ("ESC", "motor controller"),
    "sensors_navigation": ("IMU", "GNSS", "navigation"),
    "ground_segment": ("ground control station", "antenna", "launcher"),
}
# News families in order of rank; the pattern of the marking segment.
FAMILIES = (
    ("newsroom", "newsroom"),
    ("news", "news"),
    ("press", "press(?:-?releases?|-room)?"),
    ("media-center", "media-center"),
    ("blog", "(?:blog|posts?)"),
    ("stories", "stor(?:y|ies)"),
    ("articles", "articles?"),
    ("insights", "insights?"),
    ("news-events", "news-(?:and-)?events?"),
    ("announce", "announce(?:ments?)?"),
    ("updates", "updates?"),
)
# Path prefixes of localised sites, archive segments, link texts that say nothing.
LOCALES = ("es", "ja", "de", "fr", "cn", "zh", "ko", "it", "pt", "ru", "nl", "pl", "tw", "hk", "jp", "en-us", "en-gb", "en-au", "en-ca")
ARCHIVE_SEGMENTS = ("category", "tag", "tags", "author", "page", "p", "archive")
GENERIC_LINK_TEXT = ("read", "read more", "more", "view", "view more", "details", "continue", "continue reading", "see more", "learn more")
# Countries by full-match pattern; the first that matches names the country.
COUNTRIES = (
    (r"united\s+states(\s+of\s+america)?|usa?|u\.?s\.?a?\.?|america", "United States"),
    (r"united\s+kingdom|u\.?k\.?|britain|great\s+britain|england|scotland|wales|northern\s+ireland", "United Kingdom"),
    (r"germany|deutschland|federal\s+republic\s+of\s+germany", "Germany"),
    (r"france|république\s+française|french\s+republic", "France"),
    (r"italy|italia", "Italy"),
    (r"spain|españa|espana", "Spain"),
    (r"netherlands|holland|the\s+netherlands|nederland", "Netherlands"),
    (r"switzerland|schweiz|suisse|svizzera", "Switzerland"),
    (r"sweden|sverige", "Sweden"),
    (r"norway|norge", "Norway"),
    (r"denmark|danmark", "Denmark"),
    (r"finland|suomi", "Finland"),
    (r"poland|polska", "Poland"),
    (r"czech\s+republic|czechia", "Czech Republic"),
    (r"belgium|belgië|belgique", "Belgium"),
    (r"ireland|éire|eire|republic\s+of\s+ireland", "Ireland"),
    (r"portugal", "Portugal"),
    (r"austria|österreich|osterreich", "Austria"),
    (r"greece|hellas|hellenic\s+republic", "Greece"),
    (r"turkey|türkiye|turkiye|republic\s+of\s+türkiye", "Turkey"),
    (r"israel|state\s+of\s+israel", "Israel"),
    (r"estonia|eesti", "Estonia"),
    (r"latvia|latvija", "Latvia"),
    (r"lithuania|lietuva", "Lithuania"),
    (r"romania|românia", "Romania"),
    (r"slovakia|slovak\s+republic", "Slovakia"),
    (r"slovenia", "Slovenia"),
    (r"hungary|magyarország", "Hungary"),
    (r"bulgaria|българия", "Bulgaria"),
    (r"japan|日本|nihon|nippon", "Japan"),
    (r"china|prc|people'?s\s+republic\s+of\s+china", "China"),
    (r"south\s+korea|korea|republic\s+of\s+korea|rok", "South Korea"),
    (r"north\s+korea|dprk|democratic\s+people'?s\s+republic\s+of\s+korea", "North Korea"),
    (r"india|bharat", "India"),
    (r"taiwan|roc|chinese\s+taipei", "Taiwan"),
    (r"singapore|republic\s+of\s+singapore", "Singapore"),
    (r"malaysia", "Malaysia"),
    (r"thailand", "Thailand"),
    (r"vietnam|viet\s+nam", "Vietnam"),
    (r"indonesia", "Indonesia"),
    (r"philippines|republic\s+of\s+the\s+philippines", "Philippines"),
    (r"australia|aus|commonwealth\s+of\s+australia", "Australia"),
    (r"new\s+zealand|n\.?z\.?|aotearoa", "New Zealand"),
    (r"saudi\s+arabia|kingdom\s+of\s+saudi\s+arabia|ksa", "Saudi Arabia"),
    (r"united\s+arab\s+emirates|u\.?a\.?e\.?|emirates", "United Arab Emirates"),
    (r"iran|islamic\s+republic\s+of\s+iran|persia", "Iran"),
    (r"iraq|republic\s+of\s+iraq", "Iraq"),
    (r"egypt|arab\s+republic\s+of\s+egypt|misr", "Egypt"),
    (r"qatar|state\s+of\s+qatar", "Qatar"),
    (r"jordan|hashemite\s+kingdom\s+of\s+jordan", "Jordan"),
    (r"canada", "Canada"),
    (r"mexico|méxico|united\s+mexican\s+states", "Mexico"),
    (r"brazil|brasil", "Brazil"),
    (r"argentina|argentine\s+republic", "Argentina"),
    (r"chile|republic\s+of\s+chile", "Chile"),
    (r"colombia|republic\s+of\s+colombia", "Colombia"),
    (r"peru|perú|republic\s+of\s+peru", "Peru"),
    (r"south\s+africa|rsa|republic\s+of\s+south\s+africa", "South Africa"),
    (r"nigeria|federal\s+republic\s+of\s+nigeria", "Nigeria"),
    (r"kenya|republic\s+of\s+kenya", "Kenya"),
    (r"morocco|kingdom\s+of\s+morocco", "Morocco"),
    (r"russia|russian\s+federation|r\.?f\.?", "Russia"),
    (r"ukraine", "Ukraine"),
    (r"belarus|byelorussia", "Belarus"),
)
# States of the US by abbreviation.
US_STATES = {
    "AL": "Alabama", "AK": "Alaska", "AZ": "Arizona", "AR": "Arkansas", "CA": "California", "CO": "Colorado", "CT": "Connecticut", "DE": "Delaware",
    "FL": "Florida", "GA": "Georgia", "HI": "Hawaii", "ID": "Idaho", "IL": "Illinois", "IN": "Indiana", "IA": "Iowa", "KS": "Kansas",
    "KY": "Kentucky", "LA": "Louisiana", "ME": "Maine", "MD": "Maryland", "MA": "Massachusetts", "MI": "Michigan", "MN": "Minnesota", "MS": "Mississippi",
    "MO": "Missouri", "MT": "Montana", "NE": "Nebraska", "NV": "Nevada", "NH": "New Hampshire", "NJ": "New Jersey", "NM": "New Mexico", "NY": "New York",
    "NC": "North Carolina", "ND": "North Dakota", "OH": "Ohio", "OK": "Oklahoma", "OR": "Oregon", "PA": "Pennsylvania", "RI": "Rhode Island", "SC": "South Carolina",
    "SD": "South Dakota", "TN": "Tennessee", "TX": "Texas", "UT": "Utah", "VT": "Vermont", "VA": "Virginia", "WA": "Washington", "WV": "West Virginia",
    "WI": "Wisconsin", "WY": "Wyoming", "DC": "District of Columbia",
}
# Two-letter codes of countries, and the names shown for codes.
COUNTRY_ISO2 = {
    "Australia": "AU", "Austria": "AT", "Belgium": "BE", "Canada": "CA", "Croatia": "HR", "Czech Republic": "CZ", "Denmark": "DK", "Germany": "DE", "India": "IN", "Netherlands": "NL",
    "Norway": "NO", "Poland": "PL", "Slovakia": "SK", "Slovenia": "SI", "Sweden": "SE", "Switzerland": "CH", "United Kingdom": "GB", "United States": "US", "US": "US",
}
ISO2_NAMES = {"US": "United States", "GB": "United Kingdom"}
# Category slugs with their letters.
CATEGORIES = (
    ("propulsion_electronics", "propulsion-electronics", "A"),
    ("propulsion_mechanical", "propulsion-mechanical", "B"),
    ("power_systems", "power-systems", "C"),
    ("flight_and_vehicle_control", "flight-vehicle-control", "D"),
    ("sensors_and_navigation", "sensors-navigation", "E"),
    ("isr_payloads", "isr-payloads", "F"),
    ("electronic_warfare", "electronic-warfare", "G"),
    ("munitions", "munitions", "H"),
    ("communications", "communications", "I"),
    ("mechanical_subsystems", "mechanical-subsystems", "J"),
    ("structures_and_materials", "structures-materials", "K"),
    ("airframes", "airframes", "L"),
    ("recovery_systems", "recovery-systems", "M"),
    ("flight_termination", "flight-termination", "N"),
    ("ground_segment", "ground-segment", "O"),
    ("test_and_measurement", "test-measurement", "P"),
)
# Labels of compliance and readiness.
COMPLIANCE_LABELS = {"blue_uas_framework": "Blue UAS Framework", "ndaa_compliant": "NDAA-compliant", "not_eligible": "Not NDAA-eligible", "unknown": "Compliance unknown"}
READINESS_LABELS = {"production": "Production", "low_rate": "Low-rate production", "prototype": "Prototype", "engineering_services": "Engineering services", "unknown": "Readiness unknown"}
READINESS_ORDER = ("production", "low_rate", "prototype", "engineering_services")
STATUS_RANK = {"complete": 4, "partial": 3, "needs_more_fetches": 2, "failed": 1, "unknown": 0}
#: A compliance facet admits the levels listed: the more general admits the more specific.
COMPLIANCE_FACETS = {"ndaa": ("ndaa_compliant", "blue_uas_framework", "blue_uas_cleared"), "framework": ("blue_uas_framework", "blue_uas_cleared"), "cleared": ("blue_uas_cleared",)}


def lookup(value: Column, table: dict[str, str], default: Column) -> Column:
    """``table[value]`` as one CASE, else ``default``."""
    return F.coalesce(F.create_map(*[F.lit(x) for kv in table.items() for x in kv])[value], default)


def first_match(value: Column, rules: tuple[tuple[str, str], ...], default: Column) -> Column:
    """The name of the first pattern that matches all of ``value``."""
    cases = reduce(lambda c, r: c.when(value.rlike(f"^(?:{r[0]})$"), r[1]), rules[1:], F.when(value.rlike(f"^(?:{rules[0][0]})$"), rules[0][1]))
    return cases.otherwise(default)


def normalize_country(raw: Column) -> Column:
    """English name of a country written freely; unknown values pass through, stripped. Null stays null."""
    bare = F.regexp_replace(F.lower(rstrip(".", F.trim(raw))), r"\s+", " ")
    return F.when(raw.isNull() | (raw == ""), raw).otherwise(first_match(bare, COUNTRIES, F.trim(raw)))


def normalize_us_state(raw: Column) -> Column:
    """Full name of a US state given by name or abbreviation; anything else passes through, stripped."""
    bare = rstrip(".", F.trim(raw))
    table = US_STATES | {v.upper(): v for v in US_STATES.values()}
    return F.when(raw.isNull() | (raw == ""), raw).otherwise(lookup(F.upper(bare), table, bare))


def iso2(country: Column, strict: bool = False) -> Column:
    """Two-letter code; by default unlisted countries give their first two letters and a missing one US, with ``strict`` both give null."""
    other = F.lit(None).cast("string") if strict else F.left(F.upper(F.coalesce(country, F.lit("US"))), F.lit(2))
    return lookup(country, COUNTRY_ISO2, other)


def country_name(country: Column, strict: bool = False) -> Column:
    code = iso2(country, strict)
    return F.coalesce(lookup(code, ISO2_NAMES, F.lit(None).cast("string")), F.when(F.length(country) > 2, country), code)


def category_slug(raw: Column) -> Column:
    return F.when(F.coalesce(raw, F.lit("")) != "", lookup(raw, {k: s for k, s, _ in CATEGORIES}, F.replace(raw, F.lit("_"), F.lit("-"))))


def category_letter(slug: Column) -> Column:
    return lookup(slug, {s: letter for _, s, letter in CATEGORIES}, F.lit("X"))


def normalize_readiness(raw: Column) -> Column:
    return F.when(raw.isin("low_rate", "low_rate_production"), "low_rate").when(raw.isin("engineering_services", "production", "prototype"), raw).otherwise("unknown")


def compliance(ndaa: Column, blue: Column) -> Column:
    return F.when(blue == "yes", "blue_uas_framework").when(ndaa == "yes", "ndaa_compliant").when(ndaa == "no", "not_eligible").otherwise("unknown")


def compliance_label(value: Column) -> Column:
    return lookup(value, COMPLIANCE_LABELS, F.lit("Compliance unknown"))


def readiness_label(value: Column) -> Column:
    return lookup(value, READINESS_LABELS, F.lit("Readiness unknown"))


def status_rank(status: Column) -> Column:
    return reduce(lambda c, kv: c.when(status == kv[0], kv[1]), list(STATUS_RANK.items())[1:], F.when(status == "complete", 4)).otherwise(0)
