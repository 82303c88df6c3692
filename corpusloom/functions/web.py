"""Web pages: media types, metadata, main text by patterns, and DOM text; feeds, archives and URLs."""

from __future__ import annotations

from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.functions import text as t

# Supported media types, patterns of a page's main part (within one line), references and block tags.
MEDIA = ["text/html", "text/plain", "application/xhtml+xml", "application/json", "application/xml", "text/xml"]
MAIN = (
    "<main[^>]*>(.*?)</main>", "<article[^>]*>(.*?)</article>", "<div[^>]*class=[\"'][^\"']*content[^\"']*[\"'][^>]*>(.*?)</div>",
    "<div[^>]*class=[\"'][^\"']*post[^\"']*[\"'][^>]*>(.*?)</div>", "<div[^>]*class=[\"'][^\"']*entry[^\"']*[\"'][^>]*>(.*?)</div>", "<div[^>]*id=[\"']content[\"'][^>]*>(.*?)</div>",
)
REFERENCES = {"&lt;": "<", "&gt;": ">", "&quot;": '"', "&apos;": "'", "&nbsp;": " ", "&ndash;": "–", "&mdash;": "—", "&hellip;": "…", "&copy;": "©", "&reg;": "®", "&trade;": "™", "&amp;": "&"}
NOISE = ["Toggle", "subsection", "Create account", "Log in", "Main page", "Contents", "Current events", "Random article", "About Wikipedia", "Contact us", "Donate"]
SKIPPED = frozenset([
    "script", "style", "noscript", "nav", "header", "footer", "aside",
])
BLOCK = frozenset([
    "p", "div", "h1", "h2", "h3", "h4", "h5", "h6", "li", "ul", "ol", "table", "tr", "td", "th", "blockquote", "pre", "section", "article", "main",
    "br", "hr", "dl", "dt", "dd",
])


def media_type(c: Column) -> Column:
    return F.lower(t.trim(F.substring_index(c, ";", 1)))


def supported(c: Column) -> Column:
    return media_type(c).isin(*MEDIA)


def decode_references(c: Column) -> Column:
    """Twelve named references, `&amp;` last; numeric ones become a space."""
    for ref, char in REFERENCES.items():
        c = F.replace(c, F.lit(ref), F.lit(char))
    return F.regexp_replace(c, "&#[0-9]+;", " ")


def main_part(c: Column) -> Column:
    """The first main-content pattern that matches, else the whole."""
    return F.coalesce(*[F.nullif(F.regexp_extract(c, p, 1), F.lit("")) for p in MAIN], c)


def pattern_text(html: Column) -> Column:
    """Text by patterns: scripts, styles and comments out, main part, block tags to line feeds, tags out, references decoded, lines tidied."""
    c = F.regexp_replace(html, r"(?s)<script[^>]*>.*?</script>|<style[^>]*>.*?</style>|<!--.*?-->", "")
    c = F.regexp_replace(main_part(c), "</?(?:p|div|br|h[1-6]|li|ul|ol|tr|table)[^>]*>", "\n")
    c = decode_references(F.regexp_replace(c, "<[^>]*>", ""))
    tidy = F.filter(F.transform(t.lines(c), lambda x: t.trim(F.regexp_replace(x, "[ \\t]+", " "))), lambda x: x != "")
    return F.array_join(tidy, "\n")


def title(html: Column) -> Column:
    return t.trim(F.regexp_extract(html, "(?is)<title[^>]*>(.*?)</title>", 1))


def meta(html: Column, name: str) -> Column:
    """Content of a meta element by name or property; null if there is none."""
    return F.nullif(F.regexp_extract(html, f"(?i)<meta[^>]*(?:name|property)=[\"']{name}[\"'][^>]*content=[\"']([^\"']+)[\"']", 1), F.lit(""))


# Patterns of what the head of a page says.
META_TAG, META_NAME, META_PROPERTY, META_CONTENT = (r"(?is)<meta\s+([^>]*)>", r"""(?is)name=["']([^"']+)["']""", r"""(?is)property=["']([^"']+)["']""", r"""(?is)content=["']([^"']+)["']""")
JSON_LD = r"""(?is)<script[^>]*type=["']application/ld\+json["'][^>]*>([^<]+)</script>"""


def head_entries(html: Column) -> Column:
    """Every meta tag's name and property with its content, as a map; of equal keys the last wins."""
    found = lambda tag, pattern: F.nullif(F.regexp_extract(tag, pattern, 1), F.lit(""))

    def entries(tag: Column) -> Column:
        content = t.collapse(decode_references(found(tag, META_CONTENT)))
        return F.array(*[F.struct(found(tag, p).alias("key"), content.alias("value")) for p in (META_NAME, META_PROPERTY)])

    tags = F.flatten(F.transform(F.regexp_extract_all(html, F.lit(META_TAG), F.lit(1)), entries))
    kept = F.filter(tags, lambda e: e["key"].isNotNull() & e["value"].isNotNull())
    # equal keys: their values in order of the page, the last of them taken
    keys = F.array_distinct(F.transform(kept, lambda e: e["key"]))
    return F.map_from_arrays(keys, F.transform(keys, lambda k: F.element_at(F.filter(kept, lambda e: e["key"] == k), -1)["value"]))


def json_ld(html: Column) -> Column:
    """The first block of linked data, null where there is none."""
    return F.nullif(F.regexp_extract(html, JSON_LD, 1), F.lit(""))


def links(html: Column) -> Column:
    return F.regexp_extract_all(html, F.lit("(?i)<a[^>]+href=[\"']([^\"']+)[\"']"), F.lit(1))


def url_problem(url: Column) -> Column:
    """Why a URL is refused; null where it is not."""
    scheme, host = F.lower(F.coalesce(F.try_parse_url(url, F.lit("PROTOCOL")), F.lit(""))), F.try_parse_url(url, F.lit("HOST"))
    private = F.regexp_like(F.lower(F.coalesce(host, F.lit(""))), F.lit(r"^(localhost|127\..*|10\..*|192\.168\..*|169\.254\..*|172\.(1[6-9]|2[0-9]|3[01])\..*|0\.0\.0\.0)$"))
    return F.when(~scheme.isin("http", "https"), "only HTTP and HTTPS URLs are allowed").when(host.isNull(), "URL must have a host").when(private, "private hosts are not allowed")


def metadata_problem(m: Column, most: int = 50) -> Column:
    keys, values = F.map_keys(m), F.map_values(m)
    return (
        F.when(F.size(keys) > most, "too many metadata keys")
        .when(F.exists(keys, lambda k: ~F.regexp_like(k, F.lit("^[a-zA-Z0-9_-]+$")) | (F.octet_length(k) > 100)), "invalid metadata key")
        .when(F.exists(values, lambda v: F.octet_length(v) > 1000), "metadata value too long")
    )


def stable_id(url: Column) -> Column:
    """md5 of scheme, host, path and query: the fragment does not count."""
    q = F.try_parse_url(url, F.lit("QUERY"))
    return F.md5(F.concat(F.try_parse_url(url, F.lit("PROTOCOL")), F.lit("://"), F.try_parse_url(url, F.lit("AUTHORITY")), F.coalesce(F.try_parse_url(url, F.lit("PATH")), F.lit("")), F.when(q.isNotNull(), F.concat(F.lit("?"), q)).otherwise("")))


# -- DOM ---------------------------------------------------------------------------------------------------------------


class _Dom(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.parts: list[str] = []
        self.skip, self.stack = 0, []

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in SKIPPED:
            self.skip += 1
        self.stack = (self.stack + [tag])[-64:]

    def handle_endtag(self, tag: str) -> None:
        if tag in SKIPPED and self.skip:
            self.skip -= 1
        if tag in self.stack:
            while self.stack.pop() != tag:
                pass

    def handle_data(self, data: str) -> None:
        if not self.skip and data.strip() and "title" not in self.stack:
            self.parts.append(f"\n{data.strip()}\n" if self.stack and self.stack[-1] in BLOCK else f" {data.strip()} ")


def _dom(html: str) -> str:
    p = _Dom()
    p.feed(html)
    p.close()
    out = "\n\n".join(x for x in (" ".join(line.split()) for line in "".join(p.parts).split("\n")) if x)
    for n in NOISE:
        out = out.replace(n + "\n\n", "").replace("\n\n" + n, "")
    return out.strip()


@F.pandas_udf(T.StringType())
def dom_text(html: pd.Series) -> pd.Series:
    """Text of the DOM without scripts, navigation and page furniture; blocks as paragraphs."""
    return html.map(_dom, na_action="ignore")


# -- formats -----------------------------------------------------------------------------------------------------------


def simple_html_text(c: Column) -> Column:
    return t.trim(F.regexp_replace(F.regexp_replace(c, "(?s)<script.*?</script>|<style.*?</style>", ""), "<[^>]*>", ""))


def extracted(c: Column, kind: Column) -> Column:
    """Text by lower-cased format; what is not known counts as plain text."""
    return F.when(F.lower(kind) == "html", simple_html_text(c)).otherwise(c)


def sniff(c: Column) -> Column:
    """Format of what an archive returned, from its first hundred characters."""
    head = F.lower(t.trim(F.left(c, F.lit(100))))
    return F.when(head == "", "empty").when(F.startswith(head, F.lit("<?xml")), "xml").when(F.startswith(head, F.lit("warc/")), "warc").when(F.contains(head, F.lit("<html")) | F.contains(head, F.lit("<!doctype")), "html").otherwise("unknown")


def warc_body(c: Column) -> Column:
    """Body of a WARC record after its two headers; null if there is none of a hundred bytes."""
    cut = lambda sep: F.split(c, sep)
    parts = F.when(F.contains(c, F.lit("\r\n\r\n")), cut("\r\n\r\n")).otherwise(cut("\n\n"))
    body = F.array_join(F.slice(parts, 3, F.greatest(F.size(parts), F.lit(1))), "\n\n")
    return F.when((F.size(parts) >= 3) & (F.octet_length(body) >= 100), body)


def surt_url(key: Column) -> Column:
    """URL of a SURT key such as `org,example)/path`, from its first two labels."""
    host, path = F.substring_index(key, ")", 1), F.substring(key, F.locate(")", key) + 1, 100000)
    labels = F.split(host, ",")
    return F.concat(F.lit("https://"), F.get(labels, F.lit(1)), F.lit("."), F.get(labels, F.lit(0)), path)


def cdx(line: Column) -> dict[str, Column]:
    parts = F.split(line, " ", 3)
    record = F.from_json(F.get(parts, F.lit(2)), "url string, mime string, status string, length string, offset string, filename string")
    return {"url": F.coalesce(record["url"], surt_url(F.get(parts, F.lit(0)))), "captured": F.get(parts, F.lit(1)), "mime": record["mime"], "status": record["status"]}
