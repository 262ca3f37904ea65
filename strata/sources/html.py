"""HTML pages -> item rows (SRC8), with JVM regex functions only.

``page_links`` and ``page_articles`` take flat elements by patterns. ``repo_items`` scans balanced tags
(``balanced_pieces``): elements nested in their like, comments and scripts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# --- fixed values: defaults of a scraped item --------------------------------
DEFAULT_DESCRIPTION = ""
DEFAULT_LANGUAGE = "Unknown"
# -------------------------------------------------------------------------------

TAG = r"<[^>]*>"


def strip_tags(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(c, TAG, ""), r"^\s+|\s+$", "")


def unescape_basic(c: Column) -> Column:
    """Decode the five XML entities (``&amp;`` last, so ``&amp;lt;`` stays ``&lt;``)."""
    for ent, ch in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        c = F.replace(c, F.lit(ent), F.lit(ch))
    return c


def parse_count(text: Column) -> Column:
    """First white-space token, thousands commas removed, as bigint; 0 if unparsable."""
    token = F.split(F.trim(text), r"\s+").getItem(0)
    return F.coalesce(F.regexp_replace(token, ",", "").try_cast("bigint"), F.lit(0).cast("bigint"))


def page_links(pages: DataFrame, page_id: str = "page_id", html: str = "html") -> DataFrame:
    """Every anchor with an ``href``: its position among them, its target and its whole text (nested tags removed).

    One pattern takes each anchor whole, so a target and a text always belong together.
    """
    whole = F.regexp_extract_all(F.col(html), F.lit(r"(?is)<a\b[^>]*>.*?</a>"), 0)
    href = lambda a: F.regexp_extract(a, r"(?is)^<a\b[^>]*?\bhref\s*=\s*[\"']([^\"']*)", 1)
    linked = F.filter(whole, lambda a: a.rlike(r"(?is)^<a\b[^>]*?\bhref\s*="))
    return pages.select(page_id, F.posexplode(linked).alias("_pos", "_a")).select(
        page_id, (F.col("_pos") + 1).alias("position"), href(F.col("_a")).alias("href"),
        F.regexp_replace(F.col("_a"), TAG, "").alias("anchor_text"),
    )


def page_articles(pages: DataFrame, page_id: str = "page_id", html: str = "html") -> DataFrame:
    """One row per ``<article>``: title, heading, first paragraph (default ``""``), paragraphs."""
    items = pages.select(
        page_id,
        unescape_basic(F.regexp_extract(F.col(html), r"<title>(.*?)</title>", 1)).alias("title"),
        F.explode(F.regexp_extract_all(F.col(html), F.lit(r"(?s)<article>(.*?)</article>"), 1)).alias("_item"),
    )
    first_p = F.regexp_extract(F.col("_item"), r"(?s)<p>(.*?)</p>", 1)
    return items.select(
        page_id,
        "title",
        unescape_basic(strip_tags(F.regexp_extract(F.col("_item"), r"(?s)<h[1-6][^>]*>(.*?)</h[1-6]>", 1)))
        .alias("heading"),
        F.coalesce(unescape_basic(strip_tags(first_p)), F.lit(DEFAULT_DESCRIPTION)).alias("description"),
        F.size(F.regexp_extract_all(F.col("_item"), F.lit("<p>"), 0)).alias("paragraphs"),
    )


# A comment, a script or a style sheet as a whole, a tag, or a run of text.
_PIECE = r"""(?is)<!--.*?(?:-->|$)|<(?:script|style)\b[^>]*>.*?(?:</(?:script|style)\s*>|$)|</?[a-z](?:[^>"']|"[^"]*"|'[^']*')*>|[^<]+|<"""
_MARKUP = r"(?s)^<(?:!--|/?[a-zA-Z])"


def balanced_pieces(pages: DataFrame, html: str, keep=()) -> DataFrame:
    """One row per page: the ``keep`` columns and ``pieces``, its tags, texts and comments in order, of any nesting.

    A piece is (pos, piece, tag, end): ``tag`` is the name of a tag that opens an element, ``end`` the position of the tag that closes it (of the page's end,
    if none does). The depth of a tag is a running sum over the page's tags of that name, at least 0, so that a closing tag without an opening one is
    passed over; the opening and closing tags of one depth alternate, so that an element ends at the next tag of its depth. A page's
    pieces meet in one task, sorted; no other page's do.
    """
    numbered = pages.select(*keep, F.col(html).alias("_html"), F.monotonically_increasing_id().alias("_id"))
    cut = numbered.select("_id", *keep, F.posexplode(F.regexp_extract_all("_html", F.lit(_PIECE), 0)).alias("pos", "piece")).repartition("_id")
    name = F.regexp_extract("piece", r"^</?([a-zA-Z][a-zA-Z0-9]*)", 1)
    whole = F.col("piece").rlike(r"(?is)^<(?:!--|script\b|style\b)") | F.endswith(F.col("piece"), F.lit("/>"))
    step = F.when(whole | (name == ""), 0).when(F.startswith(F.col("piece"), F.lit("</")), -1).otherwise(1)
    cut = cut.withColumns({"tag": F.lower(name), "step": step})
    order = Window.partitionBy("_id", "tag").orderBy("pos")
    sums = cut.withColumn("sum", F.sum("step").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    least = sums.withColumns({
        "low": F.least(F.lit(0), F.min("sum").over(order.rowsBetween(Window.unboundedPreceding, 0))),
        "low_before": F.least(F.lit(0), F.min("sum").over(order.rowsBetween(Window.unboundedPreceding, -1))),
    })
    matched = (F.col("step") == 1) | ((F.col("step") == -1) & (F.col("low") == F.coalesce("low_before", F.lit(0))))
    depth = F.col("sum") - F.col("low") + F.when(F.col("step") == -1, 1).otherwise(0)
    level = F.when(matched, depth)
    closed = F.lead("pos").over(Window.partitionBy("_id", "tag", "level").orderBy("pos"))
    found = least.withColumn("level", level).withColumn("end", F.when((F.col("step") == 1), closed))
    piece = F.struct("pos", "piece", F.when(F.col("step") == 1, F.col("tag")).alias("tag"), "end")
    by_page = found.groupBy("_id").agg(*[F.first(c).alias(c) for c in keep], F.array_sort(F.collect_list(piece)).alias("pieces"))
    at_end = F.transform("pieces", lambda p: p.withField("end", F.when(p["tag"].isNotNull(), F.coalesce(p["end"], F.size("pieces")))))
    return by_page.select(*keep, at_end.alias("pieces"))


def inside(pieces: Column, element: Column) -> Column:
    """The pieces inside an element; ``pieces`` hold consecutive positions."""
    return F.slice(pieces, element["pos"] - pieces[0]["pos"] + 2, element["end"] - element["pos"] - 1)


def elements(pieces: Column, tag: str, attribute: str = "", token: str = "") -> Column:
    """The elements of a name, also nested ones, in order; with ``token`` those whose attribute holds it as one of its words."""
    own = rf"(?is)\s{attribute}\s*=\s*[\"'](?:[^\"']*\s)?{token}(?:\s[^\"']*)?[\"']"
    return F.filter(pieces, lambda p: (p["tag"] == tag) & (p["piece"].rlike(own) if token else F.lit(True)))


def text_of(pieces: Column) -> Column:
    """The text of the pieces, tags and comments left out, without white space around it."""
    texts = F.filter(pieces, lambda p: ~p["piece"].rlike(_MARKUP))
    return F.regexp_replace(F.array_join(F.transform(texts, lambda p: p["piece"]), ""), r"^\s+|\s+$", "")


# --- fixed values: classes and attributes of the page layout ------------------
ITEM_CLASS, HEADING_CLASS, TEXT_CLASS, LANGUAGE_ITEMPROP, STARS_WORD = "Box-row", "h3", "col-9", "programmingLanguage", "stars"
# -------------------------------------------------------------------------------


def repo_items(pages: DataFrame, html: str = "html", base_url: str = "", keep=()) -> DataFrame:
    """SRC8 proper: a trending-style page -> repository rows (with the ``keep`` columns of the page).

    One row per item ``article``; name and url from the heading's link (items
    without one are skipped); description from the text paragraph (default
    ``""``); language from its span (default ``Unknown``); stars from the first
    span whose whole text, nested elements included, contains "stars";
    ``html_url`` is ``base_url`` followed by the link.
    """
    page, first = balanced_pieces(pages, html, keep), lambda found: F.get(found, F.lit(0))
    item = page.select(*keep, "pieces", F.explode(elements(F.col("pieces"), "article", "class", ITEM_CLASS)).alias("_item"))
    items = item.select(*keep, inside(F.col("pieces"), F.col("_item")).alias("it"))
    it, none = F.col("it"), F.lit("")
    of = lambda e: F.coalesce(text_of(inside(it, e)), none)
    heading = first(elements(it, "h2", "class", HEADING_CLASS))
    link = first(elements(inside(it, heading), "a"))
    href = F.regexp_extract(link["piece"], r"(?is)^<a\b[^>]*?\bhref\s*=\s*[\"']([^\"']*)", 1)
    desc = of(first(elements(it, "p", "class", TEXT_CLASS)))
    lang = of(first(elements(it, "span", "itemprop", LANGUAGE_ITEMPROP)))
    stars = first(F.filter(F.transform(elements(it, "span"), of), lambda s: s.contains(STARS_WORD)))
    out = items.select(
        *keep,
        F.regexp_replace(href, "^/+|/+$", "").alias("full_name"),
        F.concat(F.lit(base_url), href).alias("html_url"),
        unescape_basic(desc).alias("description"),
        F.when(lang == "", F.lit(DEFAULT_LANGUAGE)).otherwise(lang).alias("language"),
        F.coalesce(parse_count(stars), F.lit(0).cast("bigint")).alias("stargazers_count"),
    )
    return out.filter(F.col("full_name") != "")
