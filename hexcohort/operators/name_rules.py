"""Rules that apply where their pattern occurs in a name, as a table: the first declared one wins.

A substring join without a cross join: names are indexed by their runs of three letters, a pattern is looked up by the rarest
of its own, and what meets is checked.  Rows grow with the letters of the names and the names that share a pattern's rarest
run, not with names x patterns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hexcohort.sources.scratch import materialize

GRAM = 3


def _grams(text: Column, size: Column | int) -> Column:
    size = F.lit(size) if isinstance(size, int) else size
    at = F.sequence(F.lit(1), F.greatest(F.char_length(text) - size + 1, F.lit(1)))
    return F.when(F.char_length(text) >= size, F.array_distinct(F.transform(at, lambda i: F.substring(text, i, size)))).otherwise(F.array().cast("array<string>"))


def first_rules(names: DataFrame, rules: DataFrame, name: str = "name", pattern: str = "pattern", place: str = "place") -> DataFrame:
    """``(name, place, pattern)``: for each distinct name that contains a pattern, the contained one of the smallest place.

    Upper and lower case differ.  An empty pattern is in every name; null names and patterns take no part; of one pattern
    declared several times the first counts.
    """
    known = (rules.filter(F.col(pattern).isNotNull()).groupBy(F.col(pattern).alias("pattern")).agg(F.min(place).alias("place")))
    known = materialize(known.withColumn("size", F.least(F.char_length("pattern"), F.lit(GRAM))), "rules")
    distinct = materialize(names.select(F.col(name).alias("name")).filter("name IS NOT NULL").distinct(), "names")
    asked = materialize(known.filter("size > 0").select("pattern", "place", F.explode(_grams(F.col("pattern"), F.col("size"))).alias("gram")), "pattern-grams")
    sizes = [r[0] for r in known.filter("size > 0").select("size").distinct().collect()]           # at most GRAM of them
    index = None
    for size in sizes:
        part = distinct.select("name", F.explode(_grams(F.col("name"), size)).alias("gram"))
        index = part if index is None else index.unionByName(part)
    empty = known.filter("size = 0").select("place").first()
    every = distinct.select("name", F.struct(F.lit(empty[0]).alias("place"), F.lit("").alias("pattern")).alias("rule")) if empty else None
    found = None
    if index is not None:
        index = materialize(index.join(asked.select("gram").distinct(), "gram", "left_semi"), "name-grams")
        common = index.groupBy("gram").agg(F.count(F.lit(1)).alias("n"))
        rarest = (asked.join(common, "gram", "left").groupBy("pattern", "place")
                  .agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "gram")).alias("g")).select("pattern", "place", "g.gram"))
        found = (index.join(rarest, "gram").filter(F.col("name").contains(F.col("pattern")))
                 .select("name", F.struct("place", "pattern").alias("rule")))
    parts = [p for p in (found, every) if p is not None]
    if not parts:
        return distinct.limit(0).select("name", F.lit(0).alias("place"), F.lit("").alias("pattern"))
    both = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return both.groupBy("name").agg(F.min("rule").alias("rule")).select("name", "rule.place", "rule.pattern")
