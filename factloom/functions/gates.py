"""Gates on harvested texts, links and review results as Column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from factloom.functions import text as texts

# Markers, limits, hosts, prefixes and extensions.
HEAD = 8192
STATUS_MARKER = "SUPPLEMENT_SURFACE_STATUS:"
INCOMPLETE_STATUSES = ("unavailable", "scrape_error")
LEAST_CHARS, GENEROUS_CHARS, LEAST_LINES = 4000, 8000, 15
PAYWALL_SENTINELS = (
    "purchase this article", "subscription content, log in", "check if you have access through your login", "to read this article in full",
    "this is a preview of subscription content", "log in to read full text", "buy this article", "rent this article", "get access", "purchase pdf",
    "this article requires a subscription",
)
SHELL_MARKERS = (
    "eletters should relate to an article recently published", "comments and feedback on aha/asa scientific statements", "access through your institution",
    "institutional sign in", "please enable javascript", "enable cookies", "purchase access", "rent this article", "subscribe to this journal", "sign in to view",
)
PUBLISHERS = {
    "elsevier": ("10.1016/", "10.1053/", "10.1067/", "10.1054/", "10.1006/"),
    "wiley": ("10.1002/", "10.1111/", "10.1113/", "10.1096/", "10.1634/"),
    "springer": ("10.1007/", "10.1038/", "10.1186/", "10.1140/", "10.1057/", "10.1023/", "10.1134/", "10.1365/"),
}
TOOL_HOSTS = (
    "antibodies.cancer.gov", "antibodies-online.com", "assays.cancer.gov", "biocyc.org", "clinicaltrials.gov", "disgenet.org", "genecards.org", "glygen.org",
    "hgmd.cf.ac.uk", "lens.org", "lovd.nl", "malacards.org", "medlineplus.gov", "omim.org", "orphanet.org", "proteinatlas.org", "scite.ai", "uniprot.org",
)
TOOL_PATHS = ("ncbi.nlm.nih.gov/clinvar", "ncbi.nlm.nih.gov/gene", "ncbi.nlm.nih.gov/nuccore", "ncbi.nlm.nih.gov/protein")
SUPPLEMENT_EXTENSIONS = (".xlsx", ".xls", ".csv", ".tsv", ".zip", ".pdf", ".doc", ".docx", ".txt", ".rtf", ".xml")
CAPTCHA_WORDS = ("captcha", "recaptcha", "hcaptcha", "cloudflare", "please verify", "robot", "challenge", "access denied")
PURCHASE_WORDS = ("purchase", "subscribe", "buy this article", "rent this article", "institutional access", "sign in to access", "get access")
HOTSPOTS = {
    "TP53": ("R175H", "R248W", "R248Q", "R249S", "R273H", "R273C", "R282W", "G245S", "G245D", "Y220C", "C176F", "C176Y", "C242F", "C242S", "H179R", "H179Y", "M237I", "S241F", "S241C", "C277F", "Y163C"),
    "KRAS": ("G12D", "G12V", "G12C", "G12R", "G12A", "G12S", "G13D", "Q61H", "Q61L", "Q61R", "Q61G"),
    "BRAF": ("V600E", "V600K"),
    "PIK3CA": ("E545K", "H1047R", "H1047L"),
}


def holds_any(text: Column, phrases: tuple[str, ...]) -> Column:
    return F.coalesce(texts.markers(text, phrases) > 0, F.lit(False))


def abstract_only(text: Column) -> Column:
    """Whether the head says that only an abstract could be had."""
    head = F.lower(F.left(text, F.lit(HEAD)))
    both = F.contains(head, F.lit("full text could not be retrieved")) & F.contains(head, F.lit("contains only the pubmed abstract"))
    return F.coalesce(F.contains(head, F.lit("# abstract-only fallback")) | both, F.lit(False))


def incomplete_supplement(text: Column) -> Column:
    """Whether the first status line of the head says that supplements were not seen."""
    said = F.lower(F.btrim(F.regexp_extract(F.left(text, F.lit(HEAD)), STATUS_MARKER + r"([^\r\n]*)", 1), F.lit(" -!><\t")))
    return F.coalesce(said.isin(*INCOMPLETE_STATUSES), F.lit(False))


def usable_source(text: Column, least: int = 500) -> Column:
    return F.coalesce(F.length(F.left(text, F.lit(HEAD))) >= least, F.lit(False)) & ~abstract_only(text)


def reusable_source(text: Column, least: int = 500) -> Column:
    return usable_source(text, least) & ~incomplete_supplement(text)


def body_reason(markdown: Column) -> Column:
    """Why a fetched body is refused; ok if it is taken. A generous size stands in for many lines."""
    size = F.length(markdown)
    return (
        F.when(markdown.isNull() | (size == 0), "empty")
        .when(holds_any(F.lower(markdown), PAYWALL_SENTINELS), "paywall")
        .when(size < LEAST_CHARS, "short")
        .when((size < GENEROUS_CHARS) & (texts.body_lines(markdown) < LEAST_LINES), "few lines")
        .otherwise("ok")
    )


def reharvest_reason(text: Column) -> Column:
    """Why a stored text is to be fetched again; ok and already if it is not. Null: it is missing."""
    return (
        F.when(text.isNull(), "missing")
        .when(F.contains(F.left(text, F.lit(500)), F.lit("# ABSTRACT-ONLY FALLBACK")), "abstract")
        .when(F.contains(F.left(text, F.lit(200)), F.lit("# REHARVESTED FULL TEXT")), "already")
        .when(F.octet_length(text) < LEAST_CHARS, "tiny")
        .when(holds_any(F.lower(text), PAYWALL_SENTINELS), "paywall")
        .when((F.length(text) < GENEROUS_CHARS) & (texts.body_lines(text) < LEAST_LINES), "few lines")
        .otherwise("ok")
    )


def needs_retry(text: Column, status: Column, source: Column, thin: int = 5000) -> Column:
    """Whether a stored text is a stub: missing, empty, an abstract, a publisher's shell, or thin and known as an abstract."""
    head = F.lower(F.left(text, F.lit(12_000)))
    known = F.coalesce(F.lower(status) == "abstract_only", F.lit(False)) | F.coalesce(F.lower(source) == "pubmed_abstract", F.lit(False))
    stub = (text == "") | F.contains(head, F.lit("abstract-only fallback")) | holds_any(head, SHELL_MARKERS) | ((F.octet_length(text) < thin) & known)
    return text.isNull() | stub


def escalation(verdict: Column, flags: Column, missing: Column, status: Column, truncated: Column, confidence: Column, floor: float = 0.9) -> Column:
    """Reasons to repeat a cheap review at full effort; empty if there are none. `confidence` is text."""
    number = confidence.try_cast("double")
    reason = lambda c, name: F.when(F.coalesce(c, F.lit(False)), name)
    return F.array_compact(
        F.array(
            reason(F.lower(verdict) == "flag", "cheap_flagged"),
            reason(flags > 0, "cheap_flags"),
            reason(missing > 0, "cheap_missing_carriers"),
            reason((status != "") & ~F.lower(status).isin("complete", "ok"), "completeness_not_complete"),
            reason(truncated, "source_truncated"),
            reason(number < floor, "low_cheap_confidence"),
            reason(confidence.isNotNull() & number.isNull(), "unparseable_confidence"),
        )
    )


def publisher(doi: Column) -> Column:
    """The publisher by the prefix of a DOI; null if none of those known."""
    low = F.lower(doi)
    return F.coalesce(*[F.when(low.rlike("^(" + "|".join(p.replace(".", r"\.") for p in prefixes) + ")"), name) for name, prefixes in PUBLISHERS.items()])


def tool_link(url: Column) -> Column:
    """Whether a link goes to a database or tool and not to an article."""
    low = F.lower(url)
    host = F.regexp_replace(F.regexp_extract(low, r"^[a-z][a-z0-9+.-]*://([^/?#]*)", 1), r"^www\.", "")
    path = F.regexp_extract(low, r"^[a-z][a-z0-9+.-]*://[^/?#]*(/[^?#]*)", 1)
    rule = lambda names: "|".join(n.replace(".", r"\.") for n in names)
    return F.coalesce(host.rlike(rf"^(.*\.)?({rule(TOOL_HOSTS)})$") | F.concat(host, path).rlike(rf"^([^/]*\.)?({rule(TOOL_PATHS)})"), F.lit(False))


def supplement_file(href: Column) -> Column:
    """Whether the path of a link, without its query, ends like a document."""
    path = F.regexp_replace(F.trim(href), r"[?#].*$", "")
    return F.coalesce(F.lower(path).rlike("(" + "|".join(e.replace(".", r"(\.|%2e)") for e in SUPPLEMENT_EXTENSIONS) + ")$"), F.lit(False))


def paywall_cause(open_access: Column, in_archive: Column, landing: Column) -> Column:
    """Why a paper could not be had, by what registries and the landing page say."""
    low = F.lower(F.left(landing, F.lit(6000)))
    captcha, paywall = holds_any(low, CAPTCHA_WORDS), holds_any(low, PURCHASE_WORDS)
    free = F.coalesce(open_access, F.lit(False)) | F.coalesce(in_archive, F.lit(False))
    return F.when(free, F.when(captcha, "FREE_BUT_BLOCKED").otherwise("FREE_BUT_MISSED")).when(captcha & ~paywall, "FREE_BUT_BLOCKED").when(paywall, "TRULY_PAYWALLED").otherwise("LIKELY_PAYWALLED")


def valid_position(position: Column, length: Column) -> Column:
    """Within the protein; a protein of unknown length takes any."""
    return length.isNull() | ((position >= 1) & (position <= length))


def non_target_reason(short: Column, gene: Column, length: Column) -> Column:
    """hotspot for a change known from other genes, beyond for one past the end of the protein; null otherwise."""
    base = F.regexp_replace(short, "fsX$", "")
    owners = [base.isin(*changes) & (gene != name) for name, changes in HOTSPOTS.items()]
    elsewhere, own = owners[0], F.lit(False)
    for other in owners[1:]:
        elsewhere = elsewhere | other
    for name, changes in HOTSPOTS.items():
        own = own | (base.isin(*changes) & (gene == name))
    position = F.regexp_extract(short, r"^[A-Z](\d+)", 1).try_cast("int")
    return F.when(elsewhere & ~own, "hotspot").when(position > length, "beyond")
