"""URL scalars as native Columns.

Only joining, query re-encoding and entity decoding need Python; they are vectorised.  Splitting
follows RFC 3986's generic syntax by regular expression, so no odd input raises.
"""

from __future__ import annotations

from urllib.parse import parse_qsl, unquote, urlencode, urljoin, urlparse, urlunparse

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from .text import any_of, any_pattern, col, first_filled, squeeze, strings, unescape
from .vocabulary import DETAIL_KEYS, DETAIL_SEGMENTS, HOST_TYPES, LOW_TRUST_TYPES, SHORTLINK_HOSTS, CandidateRules


# Each function names its argument once where it can: expressions are trees, and a plan that nests
# them would otherwise grow with every level.


def with_scheme(c: Column | str) -> Column:
    """https:// before what has no http scheme; empty stays empty."""
    return F.regexp_replace(squeeze(c), "^(?!(?i:https?://)|$)", "https://")


def normalize_url(c: Column | str, entities: bool = True) -> Column:
    """As with_scheme, with entities decoded and // taken as https."""
    url = unescape(squeeze(c)) if entities else squeeze(c)
    return with_scheme(F.regexp_replace(url, "^//", "https://"))


def authority(url: Column) -> Column:
    return F.regexp_extract(url, r"^[^:/?#]+://([^/?#]*)", 1)


def path(url: Column) -> Column:
    """The path without the parameters of its last segment."""
    return F.regexp_extract(url, r"^[^:/?#]+://[^/?#]*([^?#;]*(?:;[^?#/]*/[^?#;]*)*)", 1)


def query(url: Column) -> Column:
    return F.regexp_extract(url, r"^[^?#]*\?([^#]*)", 1)


def clean_url(c: Column | str, entities: bool = True) -> Column:
    """A normalised http(s) URL with a host and no fragment, else empty."""
    return bare_url(normalize_url(c, entities))


def bare_url(url: Column) -> Column:
    """A URL with its scheme in lower case and without its fragment; empty without a host."""
    lower = F.regexp_replace(F.regexp_replace(url, "^(?i)https://", "https://"), "^(?i)http://", "http://")
    return F.regexp_extract(lower, r"(?s)^([^:/?#]+://[^/?#]+[^#]*?)\??(?:#.*)?$", 1)


def host_key(url: Column | str) -> Column:
    """The lower-case authority, port kept, without www."""
    return F.regexp_replace(F.lower(authority(col(url))), r"^www\.", "")


def same_host(a: Column | str, b: Column | str) -> Column:
    return host_key(a) == host_key(b)


def comparable(c: Column | str) -> Column:
    """Host without www and path without trailing slashes."""
    url = with_scheme(c)
    return F.concat(host_key(url), F.regexp_replace(path(url), "/+$", ""))


def candidate_key(c: Column | str) -> Column:
    """host/path?query of a clean URL in lower case; the scheme, www. and trailing slashes are left out."""
    whole = F.regexp_replace(F.lower(col(c)), r"^([^:/?#]+://[^/?#]+)(?=\?|$)", "$1/")
    return F.regexp_replace(whole, r"(?s)^[^:/?#]+://(?:www\.)?([^/?#]*)(/|/[^?]*[^/?])/*(?:\?(.*))?$", "$1$2?$3")


def canonical(c: Column | str) -> Column:
    """scheme://host/path, the host in lower case; empty without a host."""
    raw = F.trim(col(c))
    url = F.when(raw.rlike("^https?://"), raw).otherwise(F.concat(F.lit("https://"), raw))
    at = path(url)
    whole = F.concat(F.lower(F.regexp_extract(url, "^([^:]*)", 1)), F.lit("://"), F.lower(authority(url)), F.when(at == "", "/").otherwise(at))
    return F.when((raw == "") | (authority(url) == ""), "").otherwise(whole)


@F.pandas_udf(StringType())
def _unquote(s: pd.Series) -> pd.Series:
    return s.map(unquote, na_action="ignore")


def decoded(c: Column | str) -> Column:
    """The URL in lower case with percent escapes decoded; bad UTF-8 is replaced."""
    return F.lower(_unquote(col(c)))


@F.pandas_udf(StringType())
def _urljoin(base: pd.Series, href: pd.Series) -> pd.Series:
    def one(b, h):
        try:
            return urljoin(b or "", h or "")
        except ValueError:
            return ""

    return pd.Series([one(b, h) for b, h in zip(base, href, strict=True)], dtype=object)


def join_url(base: Column | str, href: Column | str) -> Column:
    """The absolute URL of a link on a page."""
    return _urljoin(col(base), col(href))


def join_path(base: Column, at: Column) -> Column:
    """A link that begins with one slash, resolved without Python."""
    return F.concat(F.regexp_extract(base, "^([^:/?#]+://[^/?#]*)", 1), at)


def url_type(c: Column | str, hosts: dict | None = None, shortlinks: tuple = SHORTLINK_HOSTS) -> Column:
    """The kind of site: exact hosts, then hosts without www, short links, blogs, social sites, else official_or_unknown."""
    hosts = HOST_TYPES if hosts is None else hosts
    url = with_scheme(c)
    host = F.lower(authority(url))
    bare = F.regexp_replace(host, r"^www\.", "")
    table = F.create_map(*[F.lit(x) for pair in hosts.items() for x in pair])
    kind = F.coalesce(F.try_element_at(table, host), F.try_element_at(table, bare))
    rest = F.when(bare.isin(*shortlinks), "shortlink").when(F.contains(host, F.lit("naver.com")) & F.contains(host, F.lit("blog")), "blog").when(F.contains(host, F.lit("instagram.com")), "social")
    return F.when(url == "", "").otherwise(F.coalesce(kind, rest.otherwise("official_or_unknown")))


def query_keys(url: Column) -> Column:
    """The names of the query's parameters, decoded, in lower case."""
    pairs = F.filter(F.split(query(url), "&"), lambda p: p != "")
    names = F.transform(pairs, lambda p: F.regexp_extract(p, "^([^=]*)", 1))
    # an escape that is none stays as it is
    return F.transform(names, lambda n: F.lower(F.coalesce(F.try_url_decode(n), F.replace(n, F.lit("+"), F.lit(" ")))))


def is_detail(c: Column | str, keys: tuple = DETAIL_KEYS, decoded_url: Column | None = None) -> Column:
    """Whether a URL looks like one item's page."""
    url = col(c)
    text = decoded(url) if decoded_url is None else decoded_url
    return F.arrays_overlap(query_keys(url), strings(keys)) | text.rlike("/(detail|view|read)")


def infer_list_urls(c: Column | str) -> Column:
    """Array of (url, reason): list pages that a detail page hints at, distinct, without itself."""
    return _infer(clean_url(c))


@F.pandas_udf(ArrayType(StructType([StructField("url", StringType()), StructField("reason", StringType())])))
def _infer(s: pd.Series) -> pd.Series:
    return s.map(lambda url: _inferred(url) if url else [])


def _inferred(url: str) -> list[dict]:
    at = urlparse(url)
    make = lambda **k: urlunparse(at._replace(fragment="", **k))
    found: list[tuple[str, str]] = []
    segments = [x for x in at.path.split("/") if x]
    if segments and segments[-1].lower() in DETAIL_SEGMENTS:
        parent = segments[:-1]
        found = [(make(path="/" + "/".join([*parent, *tail]), query=""), reason) for tail, reason in (([], "removed_detail_path"), (["list"], "detail_to_list"), (["index"], "detail_to_index"))]
    if any(word in at.path.lower() for word in ("detail", "view", "read")):
        found.append((make(query=""), "removed_detail_query"))
    pairs = parse_qsl(at.query, keep_blank_values=True)
    kept = [p for p in pairs if p[0].lower() not in DETAIL_KEYS]
    if len(kept) < len(pairs):
        found.append((make(query=urlencode(kept, doseq=True)), "removed_detail_params"))
    first = {}
    for u, reason in found:
        if u != url:
            first.setdefault(u, reason)
    return [{"url": u, "reason": r} for u, r in first.items()]


def best_url(existing: Column | str, api: Column | str) -> Column:
    """Struct (url, source): the better of a row's own URL and the one that a search found."""
    own, found = col(existing), col(api)
    own_type, found_type = url_type(own), url_type(found)
    better = (own_type.isin(*LOW_TRUST_TYPES) & (found_type == "official_or_unknown")) | (own_type.isin("store", "shortlink", "booking") & ~found_type.isin("store", "shortlink", "booking"))
    source = (
        F.when((own == "") & (found == ""), "").when(own == "", "naver_api").when(found == "", "existing")
        .when(comparable(own) == comparable(found), "existing_api_same").when(better, "naver_api_preferred").otherwise("existing")
    )
    return F.struct(F.when(source.isin("naver_api", "naver_api_preferred"), found).otherwise(own).alias("url"), source.alias("source"))


def existing_url() -> Column:
    return first_filled(squeeze("official_url"), squeeze("link"))


def homepage(*columns: str) -> Column:
    """The first column that is a clean URL."""
    return first_filled(*[clean_url(c) for c in columns or ("verified_url", "input_url", "api_found_url", "official_url", "link")])


def is_relevant(url: Column, text: Column, context: Column, rules: CandidateRules | None = None) -> Column:
    """Whether a link may lead to a list page, by keywords and path patterns."""
    rules = rules or CandidateRules()
    haystack = F.concat_ws(" ", decoded(url), F.lower(col(text)), F.lower(col(context)))
    return any_of(haystack, rules.primary + rules.secondary) | any_pattern(haystack, [p for p, _, _ in rules.paths])


def search_query(*parts: Column) -> Column:
    return squeeze(F.concat_ws(" ", *parts))
