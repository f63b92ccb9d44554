"""Links, microdata and sections of stored web pages; each page is read once."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tablewright.functions import scalars, text as tx
from tablewright.operators.markup import Rule, elements
from tablewright.operators.matching import section_of
from tablewright.operators.ordered import count_below

def extract_links(
    pages: DataFrame, page: str, html: str, href_part: str = "/perfume/"
) -> DataFrame:
    """Anchors whose address contains ``href_part``: ``(page, position, href, text)``.

    Positions count from 0 over all anchors of the page.
    """
    anchors = elements(html, [Rule("link", "a", "href", value="href")])
    return pages.select(page, F.inline(anchors)).where(F.contains("value", F.lit(href_part))).select(
        page, "position", F.col("value").alias("href"), "text"
    )


def _hits(phrase: Column, target: Column, min_len: int) -> Column:
    """Words of the phrase with at least ``min_len`` characters that occur in the target."""
    found = F.filter(
        tx.words(F.lower(phrase)),
        lambda w: (F.length(w) >= min_len) & F.contains(target, w),
    )
    return F.coalesce(F.size(found), F.lit(0))


def score_links(
    queries: DataFrame, links: DataFrame, on: str, name: str, brand: str,
    href_part: str = "/perfume/", href_end: str = ".html", min_len: int = 4,
) -> DataFrame:
    """Every acceptable link of a query's result page with its score.

    A name word scores 2 in the link text and 1 in the address, a brand word 1
    in the address.
    """
    address, label = F.lower("href"), F.lower("text")
    usable = links.where(F.contains("href", F.lit(href_part)) & F.endswith("href", F.lit(href_end)))
    score = (
        _hits(F.col(name), label, min_len) * 2
        + _hits(F.col(name), address, min_len)
        + _hits(F.col(brand), address, min_len)
    )
    return queries.join(usable, on).withColumn("score", score)


def best_links(scored: DataFrame, query: str) -> DataFrame:
    """Best link per query: highest score, then first on the page."""
    best = F.min(F.struct((-F.col("score")).alias("s"), "position", "href"))
    return scored.groupBy(query).agg(best.alias("b")).select(
        query, F.col("b.href").alias("url"), (-F.col("b.s")).alias("score")
    )


def keep_all_queries(
    queries: DataFrame, found: DataFrame, query: str, arrays: Sequence[str] = ()
) -> DataFrame:
    """Queries without a result stay, with missing values and empty arrays."""
    joined = queries.join(found, query, "left")
    return joined.withColumns(
        {c: F.coalesce(F.col(c), F.array().cast("array<string>")) for c in arrays}
    )


def _first(found: Column, rule: str, part: str) -> Column:
    """``part`` of the first element of a rule; missing if there is none or it is empty."""
    value = F.get(F.filter(found, lambda e: e["rule"] == rule), 0)[part]
    return F.when(value != "", value)


def extract_rating(pages: DataFrame, page: str, html: str) -> DataFrame:
    """Rating and votes of each page; absent or unreadable values are missing.

    The rating is the whole text of the first element of that property, the
    votes are the ``content`` of theirs.
    """
    found = elements(html, [
        Rule("rating", attribute="itemprop", word="ratingValue"),
        Rule("votes", attribute="itemprop", word="ratingCount", value="content"),
    ])
    return pages.select(page, found.alias("_found")).select(
        page,
        scalars.to_double(_first(F.col("_found"), "rating", "text")).alias("rating"),
        scalars.to_long(_first(F.col("_found"), "votes", "value")).alias("votes"),
    )


def extract_sections(
    pages: DataFrame, page: str, html: str, heading_tag: str = "h4",
    label_class: str | None = "pyramid-note-label", label_tag: str = r"[a-z]\w*",
    sections: Sequence[tuple[str, Sequence[str]]] | None = None, max_length: int | None = 60,
) -> DataFrame:
    """Labels of each page in document order with the heading before them.

    ``(page, position, heading, section, label)``. Headings and labels are found
    in one pass, so the array holds them in page order and each label takes the
    last heading before it; the work stays within the row. ``heading_tag`` and
    ``label_tag`` are patterns of tags. Without ``sections`` every heading counts
    and is its own section; without ``max_length`` labels of any length do.
    """
    found = elements(html, [
        Rule("heading", heading_tag), Rule("label", label_tag, "class" if label_class else None, label_class)
    ])
    typed = F.transform(
        found,
        lambda e: F.struct(e["position"].alias("position"), (e["rule"] == "heading").alias("is_heading"), e["text"].alias("text")),
    )
    if sections is None:
        useful = F.filter("_parts", lambda p: p["is_heading"])
        section = F.lower(F.col("heading"))
    else:
        useful = F.filter(
            "_parts", lambda p: p["is_heading"] & section_of(p["text"], sections).isNotNull()
        )
        section = section_of(F.col("heading"), sections)
    # each label finds its heading by halving, before labels become rows of their own
    located = F.transform(
        F.filter("_parts", lambda p: ~p["is_heading"]),
        lambda p: F.struct(
            p["position"].alias("position"), p["text"].alias("label"),
            F.get("_heads", count_below("_at", p["position"], F.length(F.bin(F.size("_at")))) - 1)["text"].alias("heading"),
        ),
    )
    labels = (
        pages.select(page, typed.alias("_parts"))
        .withColumn("_heads", useful)
        .withColumn("_at", F.transform("_heads", lambda h: h["position"]))
        .select(page, F.inline(located))
    )
    fits = F.lit(True) if max_length is None else F.length("label") <= max_length
    return (
        labels.where(F.col("heading").isNotNull() & (F.col("label") != "") & fits)
        .select(page, "position", "heading", section.alias("section"), "label")
    )


def section_lists(labels: DataFrame, page: str, names: Mapping[str, str]) -> DataFrame:
    """One row per page with an array of labels per section, in page order.

    ``names`` maps a section to its output column. A group is one page's own labels.
    """
    ordered = F.array_sort(F.collect_list(F.struct("position", "section", "label")))
    grouped = labels.groupBy(page).agg(ordered.alias("_all"))

    def of(section: str) -> Column:
        return F.transform(F.filter("_all", lambda x: x["section"] == section), lambda x: x["label"])

    return grouped.select(page, *[of(section).alias(c) for section, c in names.items()])
