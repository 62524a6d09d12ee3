"""Multi-term search and the filtered product view."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.functions.bloom import blocks_for, filter_of, key_hash, may_hold
from shelfmark.functions.keywords import all_of, where_once
from shelfmark.functions.text import contains_all, split_terms
from shelfmark.functions.text import terms as text_terms
from shelfmark.operators.classify import in_category, uncategorized
from shelfmark.operators.rules import RuleSet
from shelfmark.session import fresh_dir

ALL, UNCATEGORIZED = "all", "uncategorized"  # Fixed values
# Characters by which texts and terms meet, at least, and texts that may hold a run before it is salted.
GRAM = 3
HOT_TEXTS = 100_000
# Queries without terms that meet a row together.
ID_BLOCK = 1000
# Runs asked for, up to which they are broadcast.
FEW_GRAMS = 100_000
# Blocks of the filter of more runs than that, at most: it is broadcast.
MOST_BLOCKS = 1 << 18
# Texts that a task cuts into runs.
CUT_TEXTS = 1 << 16


def search_text(df: DataFrame, lower_barcode: bool = False) -> Column:
    """All texts a term may be found in, one per line.

    Terms hold no white space, so none can match across two lines. The barcode is compared as it is
    with lowered terms; ``lower_barcode`` lowers it too.
    """
    barcode = F.lower("barcode") if lower_barcode else F.col("barcode")
    readings = [F.col(c) for c in ("reading", "initials") if c in df.columns]
    return F.concat_ws("\n", F.lower("name"), barcode, *readings)


def search_products(df: DataFrame, query: str, lower_barcode: bool = False) -> DataFrame:
    """Rows in which every term of the query occurs in name, barcode, reading or initials."""
    words = split_terms(query)
    if not words:
        return df
    texts = df.withColumn("_text", search_text(df, lower_barcode))
    return where_once(texts, all_of(F.col("_text"), words)).drop("_text")


def _grams(text: Column, sizes: tuple[int, ...]) -> Column:
    """All distinct runs of so many characters of a text."""

    def runs(size: int) -> Column:
        starts = F.sequence(F.lit(1), F.length(text) - size + 1)
        cut = F.transform(starts, lambda i: F.substring(text, i, F.lit(size)))
        return F.when(F.length(text) >= size, cut).otherwise(F.array().cast("array<string>"))

    return F.array_distinct(F.concat(*[runs(size) for size in sizes]))


def search_batch(df: DataFrame, queries: DataFrame) -> DataFrame:
    """Many queries at once: one row per query ``(query_id, query)`` and row it finds.

    A query finds a text if all of its terms do; one without terms finds every row. Each query meets the texts by one run
    of characters: of all runs in its terms the one that fewest texts hold. What meets is tested for all terms. Runs have GRAM
    characters, or as many as the number of texts has digits: of so many digits as few texts hold the same however many
    there are. Shorter terms are runs themselves. Runs that very many texts hold are salted. Joins of texts and queries are
    merges whatever size the files have: small files may hold very many rows, and what is broadcast passes through the driver.
    """
    spark = df.sparkSession
    # Case is settled by search_text; a barcode keeps its own and is tested as it is.
    texts = df.withColumn("_text", search_text(df))
    distinct = texts.select("_text").distinct()
    n_texts = distinct.count()
    size = max(GRAM, len(str(n_texts)))
    asked = queries.select("query_id", F.array_distinct(text_terms(F.col("query"))).alias("terms"))
    short = F.filter("terms", lambda term: F.length(term) < size)
    long = F.flatten(F.transform("terms", lambda term: _grams(term, (size,))))
    runs = asked.select("query_id", F.explode(F.array_distinct(F.concat(short, long))).alias("gram"))
    grams = runs.select("gram").distinct()
    n_grams, sizes = grams.agg(F.count(F.lit(1)), F.collect_set(F.length("gram"))).first()
    few = n_grams <= FEW_GRAMS

    def by_gram(counted: DataFrame) -> DataFrame:
        """A table of one row a run, for a join."""
        return F.broadcast(counted) if few else counted.hint("merge")

    # Dealt by a hash: Spark leaves out a second exchange by the text itself and merges partitions of few bytes.
    distinct = distinct.repartition(max(1, -(-n_texts // CUT_TEXTS)), F.xxhash64("_text"))
    cut = distinct.select("_text", F.explode(_grams(F.col("_text"), tuple(sorted(sizes)) or (GRAM,))).alias("gram"))
    if few:
        cut = cut.join(F.broadcast(grams), "gram", "left_semi")
    else:  # most runs of the texts are not asked for, and go before anything is shuffled
        blocks, key = min(blocks_for(n_grams), MOST_BLOCKS), key_hash("gram").alias("_key")
        asked_for = filter_of(grams.select(key), "_key", blocks)
        cut = may_hold(cut.select("*", key), "_key", F.broadcast(asked_for), blocks).drop("_key")
    # They are counted and met: written once, not cut twice.
    folder = fresh_dir(spark, "search-runs")
    cut.select("_text", "gram").write.parquet(folder)
    cut = spark.read.schema("_text string, gram string").parquet(folder)
    held = cut.groupBy("gram").agg(F.count(F.lit(1)).alias("n"))
    # A run that no text holds is the rarest: its query finds nothing.
    rarest = F.min_by("gram", F.struct(F.coalesce("n", F.lit(0)), "gram")).alias("gram")
    drivers = runs.join(by_gram(held), "gram", "left").groupBy("query_id").agg(rarest).join(asked.hint("merge"), "query_id")
    # At most one of so many rows is a run that is salted: few enough to broadcast.
    hot = held.where(F.col("n") > HOT_TEXTS).select("gram", F.ceil(F.col("n") / HOT_TEXTS).cast("int").alias("salts"))
    salts = F.coalesce("salts", F.lit(1))
    cut = cut.join(F.broadcast(hot), "gram", "left").select("_text", "gram", F.pmod(F.xxhash64("_text"), salts).cast("int").alias("salt"))
    drivers = drivers.join(F.broadcast(hot), "gram", "left")
    drivers = drivers.select("query_id", "terms", "gram", F.explode(F.sequence(F.lit(0), salts - 1)).alias("salt"))
    full = cut.join(drivers.hint("merge"), ["gram", "salt"]).where(contains_all(F.col("_text"), F.col("terms"))).select("_text", "query_id")
    found = texts.join(full.hint("merge"), "_text").select("query_id", *df.columns)
    return found.unionByName(_all_rows(df, asked.where(F.size("terms") == 0).select("query_id")))


def _all_rows(df: DataFrame, ids: DataFrame) -> DataFrame:
    """Every row for each id. The ids come in blocks of bounded size, and meet slices of the rows of about HOT_TEXTS."""
    blocks = ids.agg(F.ceil(F.count(F.lit(1)) / ID_BLOCK).cast("int")).scalar()
    held = ids.groupBy(F.pmod(F.xxhash64("query_id"), F.greatest(blocks, F.lit(1))).cast("int").alias("_block"))
    held = held.agg(F.collect_list("query_id").alias("_ids"))
    some = F.when(blocks > 0, F.sequence(F.lit(0), blocks - 1)).otherwise(F.array().cast("array<int>"))
    slices = df.agg(F.greatest(F.ceil(F.count(F.lit(1)) / HOT_TEXTS), F.lit(1)).cast("int")).scalar()
    held = held.withColumn("_slice", F.explode(F.sequence(F.lit(0), slices - 1)))
    dealt = df.withColumns({"_block": F.explode(some), "_slice": F.pmod(F.xxhash64(*df.columns), slices).cast("int")})
    met = dealt.join(held.hint("merge"), ["_block", "_slice"])
    return met.select(F.explode("_ids").alias("query_id"), *df.columns)


def visible_products(
    df: DataFrame, rules: RuleSet, category: str = ALL, subcategory: str | None = None, query: str = ""
) -> DataFrame:
    """Rows of a category and subcategory that a query finds.

    An unknown category holds no rows. An unknown subcategory is ignored.
    """
    if category == UNCATEGORIZED:
        df = uncategorized(df, rules)
    elif category != ALL:
        chosen = rules.category(category)
        if chosen is None:
            return df.where(F.lit(False))
        df = in_category(df, chosen)
        child = next((c for c in chosen.children if c.id == subcategory), None)
        if child is not None:
            df = in_category(df, child)
    return search_products(df, query)
