"""Joins: prefix match, enrichment, merges with diagnostics, fuzzy keys, as-of sections."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame, functions as F

from tablewright.operators.ordered import carry
from tablewright.operators.skew import key_counts, lookup_join
from tablewright.session import cut_lineage


def longest_prefix_match(
    fact: DataFrame,
    names: DataFrame,
    product: str,
    name: str,
    row_key: Sequence[str],
    out: str = "matched_name",
    listed: str | None = None,
) -> DataFrame:
    """Add the longest ``name`` that ``product`` starts with, ignoring case; NULL if none.

    Each distinct product is cut to the few lengths that names have, and the
    pieces meet the names in an equi-join, so no product is compared with every
    name. Among names differing only by case the first by ``listed`` wins.
    """
    order = F.col(listed) if listed else F.col(name)
    known = (
        names.where(F.col(name).isNotNull())
        .groupBy(F.lower(name).alias("_key"))
        .agg(F.min_by(name, order).alias("_name"))
    )
    # no more lengths than the longest name has characters
    lengths = known.agg(F.collect_set(F.length("_key"))).scalar()
    products = key_counts(fact, [product], "_rows")
    pieces = (
        products.select(product, F.lower(product).alias("_low"), lengths.alias("_lengths"))
        .select(product, "_low", F.explode("_lengths").alias("_len"))
        .where(F.col("_len") <= F.length("_low"))
        .select(product, F.substring("_low", F.lit(1), F.col("_len")).alias("_key"))
    )
    best = pieces.join(known, "_key").groupBy(product).agg(
        F.max_by("_name", F.length("_name")).alias(out)
    )
    lookup = products.join(best, product, "left")
    return lookup_join(fact, lookup, [product], "_rows", row_key).drop("_rows")


def enrich(
    fact: DataFrame, dimension: DataFrame, key: str, match_missing: bool = False
) -> DataFrame:
    """Left equi-join; repeated dimension keys fan out.

    With ``match_missing`` a missing key on one side meets a missing key on the other.
    """
    if not match_missing:
        return fact.join(dimension, key, "left")
    right = dimension.withColumnRenamed(key, "_key")
    return fact.join(right, F.col(key).eqNullSafe(F.col("_key")), "left").drop("_key")


def merge_tables(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    how: str = "inner",
    suffixes: tuple[str, str] = ("_x", "_y"),
    indicator: str | None = None,
) -> DataFrame:
    """Join on shared keys; overlapping columns get suffixes, ``indicator`` tells the origin.

    An outer join is a left join and the right rows without a partner: Spark can
    split a hot key of those two, but not of a full join.
    """
    on = list(on)
    shared = [c for c in left.columns if c in right.columns and c not in on]
    a = left.withColumnsRenamed({c: c + suffixes[0] for c in shared})
    b = right.withColumnsRenamed({c: c + suffixes[1] for c in shared})
    if indicator is not None:
        a, b = a.withColumn("_in_a", F.lit(True)), b.withColumn("_in_b", F.lit(True))
    if how.replace("_", "").lower() in ("outer", "full", "fullouter"):
        alone = b.join(a.select(*on).distinct(), on, "left_anti")
        missing = {f.name: F.lit(None).cast(f.dataType) for f in a.schema if f.name not in on}
        joined = a.join(b, on, "left").unionByName(alone.withColumns(missing))
    else:
        joined = a.join(b, on, how)
    if indicator is None:
        return joined
    origin = (
        F.when(F.col("_in_b").isNull(), "left_only")
        .when(F.col("_in_a").isNull(), "right_only")
        .otherwise("both")
    )
    return joined.withColumn(indicator, origin).drop("_in_a", "_in_b")


def merge_diagnostics(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """What a merge would do, from per-key counts; the merge itself is never built.

    ``rows_*`` are result sizes by join type, ``lost_*`` the rows without a
    partner, ``many_to_many_keys`` the keys repeated on both sides.
    """
    on = list(on)
    a = left.groupBy(*on).agg(F.count(F.lit(1)).alias("_a"))
    b = right.groupBy(*on).agg(F.count(F.lit(1)).alias("_b"))
    pair = F.coalesce("_a", F.lit(0)) * F.coalesce("_b", F.lit(0))
    both = a.join(b, on, "full")
    only_a = F.when(F.col("_b").isNull(), F.col("_a")).otherwise(0)
    only_b = F.when(F.col("_a").isNull(), F.col("_b")).otherwise(0)
    zero = F.lit(0)
    return both.agg(
        F.coalesce(F.sum("_a"), zero).alias("rows_left"),
        F.coalesce(F.sum("_b"), zero).alias("rows_right"),
        F.coalesce(F.sum(pair), zero).alias("rows_inner"),
        F.coalesce(F.sum(pair + only_a), zero).alias("rows_left_join"),
        F.coalesce(F.sum(pair + only_a + only_b), zero).alias("rows_outer"),
        F.coalesce(F.sum(only_a), zero).alias("lost_left"),
        F.coalesce(F.sum(only_b), zero).alias("lost_right"),
        F.count_if((F.col("_a") > 1) & (F.col("_b") > 1)).alias("many_to_many_keys"),
    )


def canonical_keys(
    df: DataFrame, key: str, aliases: DataFrame, alias: str, canonical: str,
    row_key: Sequence[str], out: str = "canonical_key",
) -> DataFrame:
    """Replace known aliases of a key by its canonical spelling."""
    table = aliases.select(F.col(alias).alias(key), F.col(canonical).alias(out)).dropDuplicates([key])
    lookup = key_counts(df, [key], "_rows").join(table, key, "left")
    return lookup_join(df, lookup, [key], "_rows", row_key).drop("_rows").withColumn(
        out, F.coalesce(out, key)
    )


BLOCKS = 8  # blocks that keys of one length are cut into after their common beginning; shapes the plan only


def _cuts(keys: DataFrame, key: str) -> DataFrame:
    """For each length of keys (of, cuts) the places that part it into blocks which tell keys apart equally well.

    How well the first characters tell keys apart is the entropy of these
    beginnings, so what all keys share weighs nothing and lies in one block,
    and what follows from earlier characters weighs nothing either.
    """
    beginnings = keys.where(F.char_length(key) > 0).select(
        F.char_length(key).alias("of"), F.col(key).alias("_key"), F.explode(F.sequence(F.lit(1), F.char_length(key))).alias("at")
    ).groupBy("of", "at", F.xxhash64(F.substring("_key", F.lit(1), F.col("at"))).alias("_begin")).agg(F.count(F.lit(1)).alias("n"))
    bits = beginnings.groupBy("of", "at").agg(
        (F.log2(F.sum("n")) - F.sum(F.col("n") * F.log2("n")) / F.sum("n")).alias("bits")
    )
    lists = bits.groupBy("of").agg(F.sort_array(F.collect_list(F.struct("at", "bits"))).alias("_bits"))
    total = F.element_at("_bits", -1)["bits"]
    # the last bits of the sums must not put a cut behind the place that reaches its share
    places = F.transform(F.sequence(F.lit(1), F.lit(BLOCKS - 1)), lambda j: F.array_min(
        F.transform(F.filter("_bits", lambda x: x["bits"] >= total * j / BLOCKS - 1e-9), lambda x: x["at"])
    ))
    common = F.array_max(F.transform(F.filter("_bits", lambda x: x["bits"] <= 1e-9), lambda x: x["at"]))
    places = F.array_append(places, common)
    return lists.select("of", F.array_distinct(F.filter(places, lambda at: at < F.col("of"))).alias("cuts")).unionByName(
        keys.where(F.char_length(key) == 0).limit(1).select(F.lit(0).alias("of"), F.array().cast("array<int>").alias("cuts"))
    )


def _holes(cuts: DataFrame, edits: int) -> DataFrame:
    """All choices of ``edits`` blocks (at, upto) of the keys of each length; a key of fewer blocks has empty ones at its end."""
    of = F.col("of")
    even = F.array(*[F.floor(of * j / (edits + 1)).cast("int") for j in range(1, edits + 1)])
    inner = F.when(F.size("cuts") >= edits, F.col("cuts")).otherwise(F.filter(F.array_union("cuts", even), lambda c: (c > 0) & (c < of)))
    ends = F.array_sort(F.concat(F.array(F.lit(0)), inner, F.array_repeat(of, F.greatest(F.lit(1), F.lit(edits) - F.size(inner)))))
    choices = F.array(*[F.array(*map(F.lit, c)) for c in combinations(range(max(BLOCKS + 1, 2 * edits)), edits)])
    chosen = cuts.select("of", ends.alias("_ends")).select("of", "_ends", F.explode(choices).alias("_c")).where(
        F.element_at("_c", -1) < F.size("_ends") - 1
    )
    return chosen.select("of", F.transform("_c", lambda i: F.struct(
        F.get("_ends", i).alias("at"), F.get("_ends", i + 1).alias("upto")
    )).alias("holes"))


def _parted(key: Column, edits: int, moves: Sequence[Column]) -> tuple[list[Column], list[Column], Column]:
    """What a key has around the holes of another, moved by so many characters, what it has in them, and whether it has such places."""
    starts = [F.lit(0), *[F.get("holes", i)["upto"] for i in range(edits)]]
    ends = [*[F.get("holes", i)["at"] for i in range(edits)], F.col("of")]
    places = [(start + move, end + move) for start, end, move in zip(starts, ends, moves)]
    kept = [F.substring(key, start + 1, end - start) for start, end in places]
    gaps = [(end, start) for (_, end), (start, _) in zip(places, places[1:])]
    fits = F.char_length(key) >= places[-1][1]
    for at, upto in [(F.lit(0), places[0][0]), *gaps]:
        fits = fits & (at <= upto)
    return kept, [F.substring(key, at + 1, upto - at) for at, upto in gaps], fits


def _moves(edits: int) -> list[list[int]]:
    """How far ``edits`` edits at most can move the parts of a key around as many holes; the first part stays."""
    found = [[0]]
    for _ in range(edits):
        found = [[*m, m[-1] + step] for m in found for step in range(-edits, edits + 1)]
    return [m for m in found if sum(abs(b - a) for a, b in zip(m, m[1:])) <= edits]


def _meetings(a: DataFrame, b: DataFrame, cuts: DataFrame, edits: int) -> DataFrame:
    """Pairs (left_key, right_key), some repeatedly, among which are all within ``edits`` edits.

    So many edits touch at most so many blocks of the right key; the other
    blocks stand in the left key as they are, in places moved by the edits
    before them. Keys meet on those, for each choice of blocks left out.
    ``distance`` counts the edits within the blocks left out, NULL if they are
    more; the least over all choices is that of the keys.
    """
    holes = cut_lineage(_holes(cuts, edits))
    kept, gaps, _ = _parted(F.col("right_key"), edits, [F.lit(0)] * (edits + 1))
    right = b.join(holes, F.char_length("right_key") == F.col("of")).select(
        "right_key", F.xxhash64("of", "holes", *kept).alias("_rest"), *[gap.alias(f"_b{i}") for i, gap in enumerate(gaps)]
    )
    moved = F.array(*[F.array(*map(F.lit, m)) for m in _moves(edits)])
    kept, gaps, fits = _parted(F.col("left_key"), edits, [F.get("_move", i) for i in range(edits + 1)])
    left = a.select("left_key", F.explode(moved).alias("_move")).withColumn(
        "of", F.char_length("left_key") - F.element_at("_move", -1)
    ).join(holes, "of").where(fits).select(
        "left_key", F.xxhash64("of", "holes", *kept).alias("_rest"), *[part.alias(f"_k{i}") for i, part in enumerate(kept)],
        *[gap.alias(f"_a{i}") for i, gap in enumerate(gaps)],
    )
    # keys of equal hash only are no candidates
    alike = F.concat("_k0", *[c for i in range(edits) for c in (f"_b{i}", f"_k{i + 1}")]) == F.col("right_key")
    distance = F.lit(0)
    for i in range(edits):
        own = F.levenshtein(f"_a{i}", f"_b{i}", edits)
        distance = distance + F.when(F.col(f"_a{i}") == F.col(f"_b{i}"), 0).when(own >= 0, own)
    return left.join(right, "_rest").where(alike).select(
        "left_key", "right_key", distance.alias("distance")
    ).withColumn("distance", F.when(F.col("distance") <= edits, F.col("distance")))


def _spread(keys: DataFrame, key: str) -> DataFrame:
    """Few keys over all shuffle partitions: each becomes many rows where keys meet."""
    return keys.repartition(int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions")), key)


def candidate_pairs(a: DataFrame, b: DataFrame, max_edits: int) -> DataFrame:
    """Distinct pairs (left_key, right_key) among which are all within ``max_edits`` edits."""
    return _meetings(a, b, cut_lineage(_cuts(b, "right_key")), max_edits).select("left_key", "right_key").distinct()


def fuzzy_match(
    left: DataFrame, right: DataFrame, left_key: str, right_key: str, max_edits: int = 1
) -> DataFrame:
    """Nearest right key within ``max_edits`` edits for each left key without an exact match.

    Distinct keys only; they meet on all blocks but as many as there are edits,
    and blocks tell keys apart equally well, so a part that very many keys share
    brings none of them together. Keys one edit away are found first, and only
    left keys without one look further. Ties go to the smaller right key.
    Columns: ``left_key``, ``right_key``, ``distance``.
    """
    a = left.select(F.col(left_key).alias("left_key")).where("left_key IS NOT NULL").distinct()
    b = cut_lineage(_spread(right.select(F.col(right_key).alias("right_key")).where("right_key IS NOT NULL").distinct(), "right_key"))
    open_keys = cut_lineage(_spread(a.join(b.select(F.col("right_key").alias("left_key")), "left_key", "left_anti"), "left_key"))
    cuts = cut_lineage(_cuts(b, "right_key"))
    best = F.min(F.struct("distance", "right_key")).alias("_best")
    found = open_keys.where("false").select("left_key", F.lit(None).cast("string").alias("right_key"), F.lit(None).cast("int").alias("distance"))
    for edits in range(1, max_edits + 1):
        near = _meetings(open_keys, b, cuts, edits).where("distance IS NOT NULL")
        nearest = cut_lineage(near.groupBy("left_key").agg(best).select(
            "left_key", F.col("_best")["right_key"].alias("right_key"), F.col("_best")["distance"].alias("distance")
        ))
        found = found.unionByName(nearest)
        if edits < max_edits:
            open_keys = cut_lineage(_spread(open_keys.join(nearest, "left_key", "left_anti"), "left_key"))
    return found


def project(
    df: DataFrame,
    columns: Sequence[str],
    rename: Mapping[str, str] | None = None,
    drop: Sequence[str] = (),
) -> DataFrame:
    """Rename, drop (absent names are ignored), then keep ``columns`` in that order."""
    return df.withColumnsRenamed(dict(rename or {})).drop(*drop).select(*columns)


def merge_reviews(
    corpus: DataFrame, dimension: DataFrame, row_key: Sequence[str], product: str = "product",
    name: str = "name", out: str = "perfume_name",
    rename: Mapping[str, str] | None = None, drop: Sequence[str] = ("no", "product", "url"),
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Reviews with the columns of the product their text names: prefix match, left join, projection."""
    named = longest_prefix_match(corpus, dimension, product, name, row_key, out)
    joined = enrich(named, dimension.withColumnRenamed(name, out), out)
    renames = rename if rename is not None else {"text": "review_text", "date": "review_date", "user": "reviewer"}
    kept = columns or [
        renames.get(c, c) for c in joined.columns if renames.get(c, c) not in drop
    ]
    return project(joined, kept, renames, [c for c in drop if c not in kept])


def unmatched_keys(df: DataFrame, matched: str, key: str) -> DataFrame:
    """Distinct keys of rows whose join found nothing."""
    return df.where(F.col(matched).isNull()).select(key).distinct()


def rows_without_partner(df: DataFrame, other: DataFrame, on: Sequence[str]) -> DataFrame:
    return df.join(other, list(on), "left_anti")


# Words that name a section, in order of precedence.
SECTION_WORDS = [
    ("top", ["TOP"]),
    ("middle", ["MIDDLE", "HEART"]),
    ("base", ["BASE"]),
]


def section_of(heading: Column, words: Sequence[tuple[str, Sequence[str]]] = SECTION_WORDS) -> Column:
    """Section named by a heading, NULL for other headings."""
    upper = F.upper(heading)
    section = F.lit(None).cast("string")
    for name, marks in reversed(words):
        hit = F.lit(False)
        for mark in marks:
            hit = hit | F.contains(upper, F.lit(mark))
        section = F.when(hit, F.lit(name)).otherwise(section)
    return section


def assign_sections(
    headings: DataFrame,
    labels: DataFrame,
    page: str,
    position: str,
    text: str,
    tolerance: float = 5.0,
    max_length: int = 60,
    words: Sequence[tuple[str, Sequence[str]]] = SECTION_WORDS,
) -> DataFrame:
    """Each label with the section of the last heading at or above it, within ``tolerance``.

    Labels that are blank, longer than ``max_length`` or above every heading
    are dropped. Columns: page, position, text, section.
    """
    marks = headings.select(
        page, (F.col(position) - tolerance).cast("double").alias("_at"), F.lit(0).alias("_kind"),
        F.col(position).alias("_pos"), F.lit(None).cast("string").alias("_text"),
        section_of(F.col(text), words).alias("_section"),
    ).where("_section IS NOT NULL")
    items = labels.select(
        page, F.col(position).cast("double").alias("_at"), F.lit(1).alias("_kind"),
        F.col(position).alias("_pos"), F.col(text).alias("_text"),
        F.lit(None).cast("string").alias("_section"),
    ).where((F.col("_text") != "") & (F.length("_text") <= max_length))
    filled = carry(marks.unionByName(items), "_at", "_section", "_found", groups=[page], tie=["_kind"])
    return filled.where("_kind = 1 AND _found IS NOT NULL").select(
        page, F.col("_pos").alias(position), F.col("_text").alias(text), F.col("_found").alias("section")
    )


def counts_side_by_side(datasets: Mapping[str, DataFrame], group: str, base: str) -> DataFrame:
    """Rows per group in each dataset for the groups of ``base``; absent groups count 0."""
    tagged = None
    for name, df in datasets.items():
        part = key_counts(df, [group]).withColumn("_set", F.lit(name))
        tagged = part if tagged is None else tagged.unionByName(part)
    sums = [
        F.sum(F.when(F.col("_set") == name, F.col("n")).otherwise(0)).alias(f"n_{name}")
        for name in datasets
    ]
    return tagged.groupBy(group).agg(*sums).where(F.col(f"n_{base}") > 0)


def stack_tables(*tables: DataFrame, distinct: bool = False) -> DataFrame:
    """Bag union by column name, missing columns NULL; optionally without equal rows."""
    first, *others = tables
    for other in others:
        first = first.unionByName(other, allowMissingColumns=True)
    return first.distinct() if distinct else first


def side_by_side(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Columns of both tables for equal keys; rows have no position to align on."""
    return left.join(right, key, "full")
