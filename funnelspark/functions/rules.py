"""Ordered rule classifiers: rule tables become one ``CASE`` expression."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from funnelspark.functions.text import collapse_spaces, has_token, is_present, text_or_empty

Rule = tuple[Column, object]


def first_match(rules: Sequence[Rule], default: object = None) -> Column:
    """Value of the first rule whose condition is true; later rules see only what earlier ones left."""
    expr: Column | None = None
    for condition, value in rules:
        value = value if isinstance(value, Column) else F.lit(value)
        expr = F.when(condition, value) if expr is None else expr.when(condition, value)
    tail = default if isinstance(default, Column) else F.lit(default)
    return tail if expr is None else expr.otherwise(tail)


def classify(text: Column, patterns: Sequence[tuple[str, object]], default: object = None) -> Column:
    """First ``(regex, label)`` found in ``text``."""
    return first_match([(text.rlike(p), label) for p, label in patterns], default)


def contains_first(text: Column, needles: Sequence[tuple[str, object]], default: object = None) -> Column:
    """First ``(substring, label)`` held in the lower-cased ``text``."""
    t = F.lower(F.trim(text_or_empty(text)))
    return first_match([(t.contains(n), label) for n, label in needles], default)


def lookup(c: Column, table: Mapping[object, object], default: object | None = None) -> Column:
    """Literal map lookup; a missing or NULL key gives ``default`` (a Column or literal, NULL if absent)."""
    pairs = [F.lit(x) for kv in table.items() for x in kv]
    hit = F.create_map(*pairs)[c]
    if default is None:
        return hit
    return F.coalesce(hit, default if isinstance(default, Column) else F.lit(default))


# Channel by the label of the dialled number, in order.
CHANNEL_BY_LABEL = (
    (r"outbound", "Outbound"),
    (r"live chat|tawk|multi-ai|ai agent", "Chat"),
    (r"google ads|ppc|pmax|fb ads|facebook|meta ads|geofencing|linkedin|twitter", "PPC"),
    (r"print|brochure|billboard|flyer|magnet|press release|college", "Offline"),
    (r"transfer|referral", "Referral"),
    (r"brand & ssl", "Brand"),
    (
        r"gmb|local listing|online listing|listings|yahoo local|organic|seo|website|web visitor|site visitor"
        r"|psychology today|directories|recovery\.com",
        "SEO",
    ),
    (r"direct|main line|target number", "Direct"),
)
# Channel by source name, used where the label is blank or unused.
CHANNEL_BY_SOURCE = (
    (r"^outbound calls$", "Outbound"),
    (r"ai agent|tawk to", "Chat"),
    (r"billing number|pre assessments|other static|^mat$", "Other"),
    (
        r"^ppc |^ppc-|^meta |google ads|facebook paid|facebook cta|fb ads|geofencing|linkedin|pmax"
        r"|performance max|bing paid",
        "PPC",
    ),
    (r"^print$", "Offline"),
    (r"organic|seo|gmb|bing local", "SEO"),
    (r"referral|facility transfer", "Referral"),
    (r"direct|target number|website", "Direct"),
)
# The shorter source rule of the daily brief.
BRIEF_CHANNEL_BY_SOURCE = (
    (r"^$", "Unknown"),
    (r"^outbound calls$", "Outbound"),
    (r"ai agent|tawk to", "Chat"),
    (
        r"^ppc |^ppc-|^meta |google ads|facebook paid|facebook cta|fb ads|geofencing|linkedin|pmax|performance max",
        "PPC",
    ),
    (r"organic|seo|gmb|bing local", "Organic"),
    (r"referral|facility transfer", "Referral"),
    (r"direct|target number|website", "Direct"),
)
# The source rule of the dashboard after its operational sources; published names come last.
DASHBOARD_CHANNEL_BY_SOURCE = (
    (
        r"^ppc |^ppc-|^meta |google ads|facebook paid|facebook cta|fb ads|geofencing|linkedin|pmax|performance max",
        "PPC",
    ),
    (r"^print$", "Other"),
    (r"organic|seo|gmb|bing local", "Organic"),
    (r"referral|facility transfer", "Referral"),
    (r"direct|target number|website", "Direct"),
)
# Operational sources without an owner's name; callers add those that have one.
OPERATIONAL_SOURCES = ("billing number", "pre assessments", "other static")
# The shorter lead-type lists of admissions without a stored lead type.
ADMIT_LEAD_TYPE_PATTERNS = (
    (r"alumni|word of mouth|readmission", "Alumni"),
    (r"google ads|ppc|pmax|paid", "PPC"),
    (r"internet search|organic|gmb|website|direct site", "SEO"),
)
# Lead type by free text, after the referral signal.
LEAD_TYPE_PATTERNS = (
    (r"transfer|referral|sales rep|business development|3rd party", "BD"),
    (r"alumni|word of mouth|readmission", "Alumni"),
    (r"google ads|ppc|pmax|p max|paid|meta|fb ads|facebook", "PPC"),
    (
        r"organic|seo|gmb|local listing|director|website|internet search|direct site|brand|web"
        r"|psychology today|tawk|multi-ai",
        "SEO",
    ),
    (r"step down|step-down", "Step Down"),
)
# Four channel groups from several text fields.
CHANNEL_GROUPS = (
    (r"google ads|ppc|pmax|paid|meta|fb ads|facebook", "PPC"),
    (r"transfer|referral|sales rep|business development|3rd party", "BD"),
    (r"organic|seo|gmb|local listing|internet search|website|direct site|bing", "Organic"),
)
# Canonical lead types already stored as text.
LEAD_TYPE_NAMES = {"bd": "BD", "seo": "SEO", "ppc": "PPC", "alumni": "Alumni"}
# Ad channel by campaign name token, in order.
CAMPAIGN_CHANNEL_TOKENS = (
    (("pmax",), "Performance Max"),
    (("s", "search"), "Search"),
    (("b", "brand"), "Brand Search"),
    (("display", "gdn"), "Display"),
    (("video", "yt"), "Video"),
)
# Lead dispositions.
DISPOSITIONS = {
    "Qualified": ("Good Call", "Needs Follow Up"),
    "Disqualified": ("Medicare/Medicaid", "Uninsured", "Already Working With PT", "Facility Related"),
    "Junk": ("Spam", "Wrong Number", "Missed Call"),
    "Spanish only": ("Spanish only",),
}
NO_DISPOSITION = "Unknown / no disposition"


def _holds_any(text: Column, parts: Iterable[str]) -> Column:
    hit = F.lit(False)
    for p in parts:
        hit = hit | text.contains(p.lower())
    return hit


def channel(label: Column, source: Column, direct_names: Iterable[str] = (), operational: Iterable[str] = ()) -> Column:
    """Channel by label, else by source.

    ``direct_names`` are published names that count as Direct; sources that hold one of ``operational`` are Other.
    """
    lab, src = collapse_spaces(label), collapse_spaces(source)
    names = [n.lower() for n in direct_names]
    by_label = [(lab.rlike(p), v) for p, v in CHANNEL_BY_LABEL]
    by_source = [(src.rlike(p), v) for p, v in CHANNEL_BY_SOURCE]
    by_source.insert(2, (_holds_any(src, operational), "Other"))
    if names:
        by_label.append((lab.isin(names), "Direct"))
        by_source.append((src.isin(names), "Direct"))
    from_label = F.when((lab != "") & ~lab.contains("unused"), first_match(by_label))
    return F.coalesce(from_label, first_match(by_source, "Other"))


def dashboard_channel(source: Column, direct_names: Iterable[str] = (), operational: Iterable[str] = ()) -> Column:
    """Channel of the dashboard: operational and print sources are Other, published names Direct."""
    src = collapse_spaces(source)
    head = [(src == "", "Unknown"), (src == "outbound calls", "Outbound"), (_holds_any(src, ("ai agent", "tawk to")), "Chat")]
    other = (_holds_any(src, [*OPERATIONAL_SOURCES, *operational]) | (src == "mat"), "Other")
    tail = [(src.isin([n.lower() for n in direct_names]), "Direct")] if direct_names else []
    return first_match([*head, other, *[(src.rlike(p), v) for p, v in DASHBOARD_CHANNEL_BY_SOURCE], *tail], "Other")


def admit_lead_type(company: Column, contact: Column, *texts: Column) -> Column:
    """Lead type of an admission: a referring company or contact is BD, then the first pattern, else ``Other``."""
    named = (F.trim(text_or_empty(company)) != "") | (F.trim(text_or_empty(contact)) != "")
    blob = F.lower(F.concat_ws(" ", *[text_or_empty(t) for t in (*texts, company, contact)]))
    return first_match([(named, "BD"), *[(blob.rlike(p), v) for p, v in ADMIT_LEAD_TYPE_PATTERNS]], "Other")


def brief_channel(source: Column) -> Column:
    return classify(collapse_spaces(source), BRIEF_CHANNEL_BY_SOURCE, "Other")


def lead_type(referred: Column, *texts: Column) -> Column:
    """Referral signal first, then the first text pattern, else ``Other``."""
    blob = F.lower(F.concat_ws(" ", *[text_or_empty(t) for t in texts]))
    rules = [(referred, "BD")] + [(blob.rlike(p), v) for p, v in LEAD_TYPE_PATTERNS]
    return first_match(rules, "Other")


def lead_type_name(c: Column) -> Column:
    """Stored lead type text to its canonical name."""
    t = F.lower(F.trim(text_or_empty(c)))
    rules = [(t == k, v) for k, v in LEAD_TYPE_NAMES.items()] + [(t.rlike("step.?down"), "Step Down")]
    return first_match(rules, "Other")


def channel_group(*texts: Column) -> Column:
    """Paid, referral, organic or other from several text fields."""
    blob = F.lower(F.concat_ws(" ", *[text_or_empty(t) for t in texts]))
    return classify(blob, CHANNEL_GROUPS, "Other")


def campaign_channel(name: Column) -> Column:
    rules = []
    for tokens, label in CAMPAIGN_CHANNEL_TOKENS:
        hit = has_token(name, tokens[0])
        for t in tokens[1:]:
            hit = hit | has_token(name, t)
        rules.append((hit, label))
    return first_match(rules, "Other")


def campaign_site(
    name: Column,
    account: Column,
    accounts: Mapping[str, str],
    tokens: Sequence[tuple[Sequence[str], str]],
    default: str = "Unmapped",
) -> Column:
    """Site of an ad row: whole-account rule first, then the first campaign token that is known."""
    rules = [(F.trim(account) == a, s) for a, s in accounts.items()]
    for names, site in tokens:
        hit = has_token(name, names[0])
        for t in names[1:]:
            hit = hit | has_token(name, t)
        rules.append((hit, site))
    return first_match(rules, default)


def label_site(label: Column, sites: Sequence[tuple[Sequence[str], str]], default: object = None) -> Column:
    """Site named as a whole word in a label, in any case; the first site in order wins."""
    t = text_or_empty(label)
    return first_match([(t.rlike(rf"(?i)\b(?:{'|'.join(words)})\b"), s) for words, s in sites], default)


def disposition(c: Column) -> Column:
    return first_match([(c.isin(*v), k) for k, v in DISPOSITIONS.items()], NO_DISPOSITION)


def era(d: Column, cut: object, before: str, after: str) -> Column:
    """``before`` up to and including ``cut``; undated rows belong to ``after``."""
    return F.when(d <= F.lit(cut).cast("date"), F.lit(before)).otherwise(F.lit(after))


def budget_category(rules: Sequence[tuple[Mapping[str, object], str]], default: str = "Unbudgeted") -> Column:
    """First rule all of whose tests hold.

    A test value is a text to equal, a tuple of texts any of which is contained, or ``"!x"`` to differ from x.
    """
    built = []
    for tests, label in rules:
        cond = F.lit(True)
        for name, want in tests.items():
            if isinstance(want, tuple):
                part = F.lit(False)
                for w in want:
                    part = part | F.col(name).contains(w)
            elif isinstance(want, str) and want.startswith("!"):
                part = F.col(name) != want[1:]
            else:
                part = F.col(name) == want
            cond = cond & part
        built.append((cond, label))
    return first_match(built, default)


def referred(*cols: Column) -> Column:
    """True when any of the referral columns is filled in."""
    out = is_present(cols[0])
    for c in cols[1:]:
        out = out | is_present(c)
    return out
