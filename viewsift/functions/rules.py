"""Filter rules as data, and the native expressions built from them.

Every rule here is a built-in Spark expression (LIKE / ILIKE / contains / RLIKE),
so stage B, stage C, the company classifier and the rule verdict all run inside
whole-stage codegen and push down where Parquet allows. The same data renders
the ANSI SQL used by the DuckDB oracle.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values (must equal the original pipeline's rules for equal results).
# ---------------------------------------------------------------------------

# Stage A: default traffic threshold.
DEFAULT_MIN_VIEWS = 1000

# Stage B: noise rules, case-sensitive LIKE; a title matching any is dropped.
# LIKE semantics are kept on purpose: "_" is a one-character wildcard.
STAGE_B_PATTERNS = [
    "List_of%", "History_of%", "Timeline_of%", "Comparison_of%", "Outline_of%",
    "%(film)", "%(movie)", "%(book)", "%(novel)", "%(documentary)",
    "Wikipedia:%", "Category:%", "Template:%", "Portal:%",
    "%_(person)", "%born_%", "%_(actor)", "%_(musician)", "%_(entrepreneur)",
]

# Stage C: tech keywords, case-insensitive substring (ILIKE '%k%'); any match keeps.
STAGE_C_KEYWORDS = [
    "Amazon", "Apple", "Google", "Alphabet", "Microsoft", "Meta", "Facebook",
    "Instagram", "WhatsApp", "AWS", "Android", "iPhone", "Windows", "Xbox",
    "macOS", "Azure", "iPad", "Oculus", "Pixel", "LinkedIn",
]

# Company classifier: literal substrings of the lower-cased title, first company wins.
COMPANY_KEYWORDS = [
    ("Amazon", ["amazon", "aws", "alexa", "kindle", "prime_video", "fire_tv", "echo_"]),
    ("Apple", ["apple", "iphone", "ipad", "macbook", "imac", "ios", "macos", "airpods",
               "apple_watch", "app_store", "itunes"]),
    ("Google", ["google", "android", "chrome", "youtube", "gmail", "pixel", "google_maps",
                "google_drive", "google_cloud", "nest_"]),
    ("Microsoft", ["microsoft", "windows", "xbox", "azure", "office_365", "teams", "outlook",
                   "surface", "bing"]),
    ("Meta", ["facebook", "meta", "instagram", "whatsapp", "oculus", "messenger", "threads"]),
]
OTHER_COMPANY = "Other"
COMPANIES = [c for c, _ in COMPANY_KEYWORDS] + [OTHER_COMPANY]

# The keep and remove words of the filtering instructions.
# Rule verdict (L4): the keep/remove rules of the filtering instructions, applied in
# order to the normalised title n = replace(lower(title), '_', ' '). First match wins;
# no match keeps the row ("when uncertain, lean toward KEEP").
VERDICT_RULES = [
    ("keep:suffix",
     r"\((software|service|device|operating system|app|application|game|console|product|brand|platform)\)$"),
    ("keep:allow",
     r"^(microsoft office|windows|azure|xbox|instagram|whatsapp|messenger|threads|iphone|pixel"
     r"|surface|linkedin|twitch|airpods)( [a-z0-9]+)*( \(202[0-5]\))?$"),
    ("remove:people",
     r"\b(executive|founder|ceo|director|president|chairman|employee|activist|spokesperson)\b"),
    ("remove:legal",
     r"\b(v|vs|corp|inc)\.|\b(llc|ltd|lawsuit|litigation|antitrust|settlement|court case|legal action)\b"),
    ("remove:historical",
     r"^(history|timeline|list|comparison|outline) of\b"
     r"|\b(criticism|controversy|scandal|breach|walkout|strike)\b"),
    ("remove:building",
     r"\b(building|campus|headquarters|office|tower|arena|mall|warehouse|data center|facility)\b"),
    ("remove:event",
     r"\b(conference|summit|expo|awards|challenge|competition|festival|ceremony|cup|prize)\b"),
    ("remove:media",
     r"\(tv series\)|\(miniseries\)|\btv series\b|series\)|\bseason |\(film\)|\bmovie\b|\bdocumentary\b"
     r"|\(book\)|\(novel\)|\b(advertisement|franchise)\b"),
    ("remove:techdoc",
     r"\b(version history|release history|technical problems|file format|specification|encoding|protocol)\b"),
    ("remove:url", r"\.(com|org|net|io|dev|co|uk|de)\b|http|www\.|youtube\."),
    ("remove:typography", r"\b(typeface|font)\b"),
    ("remove:year", r"\(202[0-5]"),
    ("remove:other",
     r"\b(disambiguation|category|template|portal|wikipedia page|stock|ipo|revenue|earnings"
     r"|acquisition|merger|effect|phenomenon|movement|initiative)\b"),
]
DEFAULT_VERDICT = "keep:default"

# Necessary substrings per verdict rule: a title can match the rule's regex only if
# it contains one of them. Checked first with cheap ``contains`` so the regex runs
# on few rows; ``tests/test_rules.py`` asserts regex ⇒ gate.
VERDICT_GATES = {
    "keep:suffix": [")"],
    "keep:allow": ["microsoft office", "windows", "azure", "xbox", "instagram", "whatsapp", "messenger",
                   "threads", "iphone", "pixel", "surface", "linkedin", "twitch", "airpods"],
    "remove:people": ["executive", "founder", "ceo", "director", "president", "chairman", "employee",
                      "activist", "spokesperson"],
    "remove:legal": ["v.", "vs.", "corp.", "inc.", "llc", "ltd", "lawsuit", "litigation", "antitrust",
                     "settlement", "court case", "legal action"],
    "remove:historical": [" of", "criticism", "controversy", "scandal", "breach", "walkout", "strike"],
    "remove:building": ["building", "campus", "headquarters", "office", "tower", "arena", "mall", "warehouse",
                        "data center", "facility"],
    "remove:event": ["conference", "summit", "expo", "awards", "challenge", "competition", "festival",
                     "ceremony", "cup", "prize"],
    "remove:media": ["series", "season ", "(film)", "movie", "documentary", "(book)", "(novel)",
                     "advertisement", "franchise"],
    "remove:techdoc": ["version history", "release history", "technical problems", "file format",
                       "specification", "encoding", "protocol"],
    "remove:url": [".", "http"],
    "remove:typography": ["typeface", "font"],
    "remove:year": ["(202"],
    "remove:other": ["disambiguation", "category", "template", "portal", "wikipedia page", "stock", "ipo",
                     "revenue", "earnings", "acquisition", "merger", "effect", "phenomenon", "movement",
                     "initiative"],
}

# ---------------------------------------------------------------------------
# Spark expressions
# ---------------------------------------------------------------------------


def _any(cols: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, cols)


def _all(cols: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, cols)


def stage_a_condition(as_of, min_views: int = DEFAULT_MIN_VIEWS,
                      date_col: str = "processing_date", views_col: str = "count_views") -> Column:
    """the day's rows with enough traffic. ``as_of=None`` keeps every date."""
    cond = F.col(views_col) >= F.lit(int(min_views))
    if as_of is not None:
        cond = (F.col(date_col) == F.lit(as_of).cast("date")) & cond
    return cond


def _runs(pattern: str) -> list[tuple[int, str]]:
    """Literal runs of a ``_``-only pattern with their 0-based offsets."""
    out, start = [], None
    for i, ch in enumerate(pattern + "_"):
        if ch != "_" and start is None:
            start = i
        elif ch == "_" and start is not None:
            out.append((start, pattern[start:i]))
            start = None
    return out


def like_expr(t: Column, pattern: str) -> Column:
    """``t LIKE pattern`` as cheap position checks where the pattern has ``_`` wildcards.

    Spark already turns ``x%`` / ``%x`` / ``%x%`` without ``_`` into StartsWith /
    EndsWith / Contains (and pushes them into the scan), so those stay ``like``.
    Patterns with ``_`` would become backtracking regexes; the three shapes used
    here are rewritten exactly (``P%``, ``%S``, ``%X%`` with ``_`` only at the end
    of ``X``); anything else falls back to ``like``.
    """
    if "_" not in pattern or "\\" in pattern:
        return t.like(pattern)
    n = F.length(t)
    body = pattern.strip("%")
    if "%" in body or not body.isascii():
        return t.like(pattern)
    # A literal run at the very start (P%) or end (%S) is a byte-level startswith /
    # endswith (the same test, as the run is ASCII); it goes first, so most titles
    # fail before any substring is cut or any length counted.
    if pattern.endswith("%") and not pattern.startswith("%"):          # P%
        runs = _runs(body)
        gate = [t.startswith(r) for off, r in runs if off == 0]
        conds = [F.substring(t, off + 1, len(r)) == r for off, r in runs if off != 0]
        return _all(gate + conds + [n >= len(body)])
    if pattern.startswith("%") and not pattern.endswith("%"):          # %S
        runs = _runs(body)
        gate = [t.endswith(r) for off, r in runs if off + len(r) == len(body)]
        conds = [F.substring(t, -(len(body) - off), len(r)) == r for off, r in runs
                 if off + len(r) != len(body)]
        return _all(gate + conds + [n >= len(body)])
    lit = body.rstrip("_")
    if pattern.startswith("%") and pattern.endswith("%") and lit and "_" not in lit:  # %X_..%
        # the first occurrence leaves the most room after it
        pos = F.locate(lit, t)
        return t.contains(lit) & (pos + F.lit(len(body) - 1) <= n)  # byte search gates the char position
    return t.like(pattern)


def stage_b_condition(title_col: str = "page_title") -> Column:
    """no noise pattern matches (case-sensitive LIKE semantics, ``_`` = one character)."""
    t = F.col(title_col)
    return _all([~like_expr(t, p) for p in STAGE_B_PATTERNS])


def stage_c_condition(title_col: str = "page_title") -> Column:
    """some tech keyword occurs, case-insensitively (ILIKE '%k%').

    ``ILIKE`` lower-cases both sides per call; lower-casing the title once and
    testing ``contains`` with the lower-cased keyword is the same predicate.
    """
    low = F.lower(F.col(title_col))
    return _any([low.contains(k.lower()) for k in STAGE_C_KEYWORDS])


def company_expr(title_col: str = "page_title") -> Column:
    """Company of a title; literal substrings, first match wins (no UDF)."""
    low = F.lower(F.col(title_col))
    expr = None
    for company, words in COMPANY_KEYWORDS:
        cond = _any([low.contains(w) for w in words])
        expr = F.when(cond, F.lit(company)) if expr is None else expr.when(cond, F.lit(company))
    return expr.otherwise(F.lit(OTHER_COMPANY))


def portable(pattern: str) -> str:
    """``pattern`` with word borders spelled out over ``[a-z0-9]``.

    Regex engines differ on what ``\\b`` takes for a word character beside ASCII
    (an accented letter is one in Java, none in RE2); this form means the same in all.
    """
    opening = re.sub(r"\\b(?=[(a-z])", "(?:^|[^a-z0-9])", pattern)
    return opening.replace(r"\b", "(?:[^a-z0-9]|$)")


def normalised_title(title_col: str = "page_title") -> Column:
    return F.replace(F.lower(F.col(title_col)), F.lit("_"), F.lit(" "))


def verdict_expr(title_col: str = "page_title", normalised: Column | None = None) -> Column:
    """L4: rule verdict label, e.g. ``keep:allow`` or ``remove:legal``.

    Each rule is ``gate AND rlike``: the gate (any necessary substring) is a few
    byte searches, so most rows never reach the regex. ``normalised`` is the
    normalised title where a column holds it.
    """
    n = normalised_title(title_col) if normalised is None else normalised
    expr = None
    for label, pattern in VERDICT_RULES:
        gate = VERDICT_GATES.get(label)
        found = n.rlike(portable(pattern))
        cond = found if not gate else (_any([n.contains(g) for g in gate]) & found)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(DEFAULT_VERDICT))


def is_kept(verdict_col: str = "verdict") -> Column:
    return F.col(verdict_col).startswith("keep:")


def is_kept_title(title_col: str = "page_title") -> Column:
    """L4: whether the verdict of a title is a ``keep``."""
    return verdict_expr(title_col).startswith("keep:")


# ---------------------------------------------------------------------------
# The same rules as ANSI SQL text (DuckDB oracle)
# ---------------------------------------------------------------------------


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def sql_stage_b(t: str = "page_title") -> str:
    return "(" + " AND ".join(f"{t} NOT LIKE {_q(p)}" for p in STAGE_B_PATTERNS) + ")"


def sql_stage_c(t: str = "page_title") -> str:
    return "(" + " OR ".join(f"{t} ILIKE {_q('%' + k + '%')}" for k in STAGE_C_KEYWORDS) + ")"


def sql_company(t: str = "page_title") -> str:
    parts = []
    for company, words in COMPANY_KEYWORDS:
        cond = " OR ".join(f"contains(lower({t}), {_q(w)})" for w in words)
        parts.append(f"WHEN {cond} THEN {_q(company)}")
    return "CASE " + " ".join(parts) + f" ELSE {_q(OTHER_COMPANY)} END"


def sql_verdict(t: str = "page_title") -> str:
    n = f"replace(lower({t}), '_', ' ')"
    parts = [f"WHEN regexp_matches({n}, {_q(p)}) THEN {_q(label)}" for label, p in VERDICT_RULES]
    return "CASE " + " ".join(parts) + f" ELSE {_q(DEFAULT_VERDICT)} END"
