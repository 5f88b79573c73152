"""Links of an HTML page as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HIDDEN = r"(?is)<script\b.*?</script>|<style\b.*?</style>|<!--.*?-->"
ANCHOR = r"(?i)<a(?:\s(?:[^>\"']|\"[^\"]*\"|'[^']*')*)?>"
HREF = r"(?i)\shref\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))"
BASE = r"(?i)<base(?:\s(?:[^>\"']|\"[^\"]*\"|'[^']*')*)?>"
WEB = "^(?i)https?://"
# Scheme, authority, path, query and fragment, each with its own marks, empty when it is missing.
URL = r"(?s)^([A-Za-z][A-Za-z0-9+.\-]*:)?(//[^/?#]*)?([^?#]*)(\?[^#]*)?(#.*)?\z"


def _href(tag: Column) -> Column:
    """Value of href, null when the tag has none; an empty value stays empty."""
    value = F.concat(*[F.regexp_extract(tag, HREF, i) for i in (1, 2, 3)])
    return F.when(tag.rlike(HREF), F.replace(value, F.lit("&amp;"), F.lit("&")))


def anchors(page: Column) -> Column:
    """ARRAY<STRUCT<ordinal INT, href STRING>> of all anchors, ordinal from 1.

    Script, style and comments hold no anchors.
    """
    visible = F.regexp_replace(page, HIDDEN, "")
    tags = F.regexp_extract_all(visible, F.lit(ANCHOR), F.lit(0))
    return F.transform(tags, lambda tag, i: F.struct(
        (i + 1).cast("int").alias("ordinal"), _href(tag).alias("href")))


def followed(links: Column, max_links: int) -> Column:
    """Anchors a crawler follows: those with an href up to ordinal ``max_links``,
    and the first one with an href after it."""
    linked = F.filter(links, lambda a: a["href"].isNotNull())
    beyond = F.filter(linked, lambda a: a["ordinal"] > max_links)
    last = F.coalesce(F.try_element_at(beyond, F.lit(1))["ordinal"], F.lit(max_links))
    return F.filter(linked, lambda a: a["ordinal"] <= last)


def is_web_link(href: Column) -> Column:
    return href.rlike(WEB)


def _without_dots(path: Column) -> Column:
    """A path that begins with a slash, its segments ``.`` and ``..`` carried out."""
    segments = F.split(F.substr(path, F.lit(2)), "/")
    kept = F.aggregate(segments, F.array().cast("array<string>"), lambda kept, s: (
        F.when(s == ".", kept)
        .when(s == "..", F.slice(kept, 1, F.greatest(F.size(kept) - 1, F.lit(0))))
        .otherwise(F.array_append(kept, s))))
    ended = F.element_at(segments, -1).isin(".", "..")      # such a path ends with a slash
    whole = F.concat(F.lit("/"), F.array_join(F.when(ended, F.array_append(kept, F.lit(""))).otherwise(kept), "/"))
    return F.when(path.startswith("/") & path.contains("/."), whole).otherwise(path)


def resolve(base: Column, href: Column) -> Column:
    """The absolute address of a link on a page with address ``base`` (RFC 3986, section 5).

    White space around a link and line breaks in it do not count.  An empty link is the
    page itself.  Null if either is null.
    """
    link = F.regexp_replace(F.regexp_replace(href, r"^[\x00-\x20]+|[\x00-\x20]+\z", ""), r"[\t\r\n]", "")
    scheme, authority, path, query, fragment = (F.regexp_extract(link, URL, i) for i in range(1, 6))
    b_scheme, b_authority, b_path, b_query = (F.regexp_extract(base, URL, i) for i in range(1, 5))
    own, hosted = scheme != "", authority != ""
    folder = F.when((b_authority != "") & (b_path == ""), "/").otherwise(F.regexp_extract(b_path, "(?s)^(.*/)?", 0))
    merged = F.when(own | hosted | path.startswith("/"), path).when(path == "", b_path).otherwise(F.concat(folder, path))
    same_page = ~own & ~hosted & (path == "") & (query == "")
    return F.concat(
        F.when(own, scheme).otherwise(b_scheme), F.when(own | hosted, authority).otherwise(b_authority),
        F.when(path == "", merged).otherwise(_without_dots(merged)), F.when(same_page, b_query).otherwise(query), fragment)


def base_address(page: Column, url: Column) -> Column:
    """What a page's links are relative to: its first ``<base>`` with an href, else its own address."""
    tags = F.regexp_extract_all(F.regexp_replace(page, HIDDEN, ""), F.lit(BASE), F.lit(0))
    given = F.try_element_at(F.filter(F.transform(tags, _href), lambda h: h.isNotNull()), F.lit(1))
    return F.coalesce(resolve(url, given), url)
