"""URL filters by listed hosts and paths.

Everything is built of DataFrame expressions. A blocked Bloom filter of the
listed URLs (one 64-bit word per block) is tested first; what it passes goes to
an exact hash join with the list, which removes the false positives.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bronzeway.llm.common import fresh, lower_ascii

#: 64-bit words of the Bloom filter: 128 KB. The size is fixed, so a longer list
#: only lets more candidates through to the exact join.
FILTER_WORDS = 1 << 14


def url_parts(url: Column) -> tuple[Column, Column]:
    """(host, path) of a URL, both empty if it is NULL or has no ``://``.

    The host ends before ``/``, ``?`` or ``#`` and gets its A-Z lower-cased; the
    path ends before ``?`` or ``#`` and stays as it is.
    """
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = lower_ascii(F.regexp_extract(rest, r"^([^/?#]*)", 1))
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def _word(key: Column, words: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(words)).cast("int")


def _bits(key: Column) -> Column:
    """Four of the 64 bits of the key's word, from a second hash."""
    second = F.xxhash64(key, F.lit("bits"))
    bits = F.lit(0).cast("bigint")
    for shift in (0, 6, 12, 18):
        place = F.shiftright(second, shift).bitwiseAND(F.lit(63)).cast("int")
        # shiftleft() wants a constant; CALL_FUNCTION takes a column
        bits = bits.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("bigint"), place))
    return bits


def bloom_words(keys: DataFrame, key: str, words: int = FILTER_WORDS) -> DataFrame:
    """One row with ``words``: the filter of all keys, an array of fixed length."""
    filled = keys.groupBy(_word(F.col(key), words).alias("at")).agg(
        F.bit_or(_bits(F.col(key))).alias("bits")
    )
    every = keys.sparkSession.range(words).select(F.col("id").cast("int").alias("at"))
    dense = every.join(filled, "at", "left").select(
        F.struct("at", F.coalesce("bits", F.lit(0).cast("bigint")).alias("bits")).alias("e")
    )
    ordered = F.array_sort(F.collect_list("e"))
    return dense.agg(F.transform(ordered, lambda e: e["bits"]).alias("words"))


def may_contain(filter_words: Column, key: Column, words: int = FILTER_WORDS) -> Column:
    bits = _bits(key)
    return F.get(filter_words, _word(key, words)).bitwiseAND(bits) == bits


def filter_urls(
    rows: DataFrame,
    rules: DataFrame,
    url: str = "url",
    default: str = "allow",
    words: int = FILTER_WORDS,
) -> DataFrame:
    """Add ``host``, ``path``, ``rule`` and ``verdict`` to every row.

    ``rules`` has host, path and action. A rule fits its host and all its
    subdomains if the path starts with the rule's; the longest (host and path
    together, then host) wins, and gives its text as ``rule`` and its action as
    ``verdict``. Without one, ``rule`` is NULL and ``verdict`` the default.

    NULL, empty or malformed URLs have an empty host and path and fit no rule.
    Rules with a NULL are ignored; of equal rules with different actions the
    later in the alphabet counts, so block wins over allow. Columns of the
    result's names that the input has are replaced; repeated rows stay repeated.
    """
    host, path = url_parts(F.col(url))
    judged = rows.withColumns({"host": host, "path": path})
    rules = (
        rules.select(lower_ascii(F.col("host")).alias("host"), "path", "action")
        .dropna()
        .groupBy("host", "path")
        .agg(F.max("action").alias("action"))
    )
    hosts = rules.select("host").distinct()
    pairs = rules.select(F.concat_ws("\n", "host", "path").alias("key"))
    lengths = rules.agg(F.collect_set(F.length("path")).alias("lengths"))  # no more than the longest path

    labels = F.split("host", r"\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."),
    )
    keys = judged.select("host", "path").distinct()
    hits = (
        keys.withColumn("suffix", F.explode(suffixes))
        .filter(may_contain(bloom_words(hosts, "host", words).scalar(), F.col("suffix"), words))
        .withColumn("length", F.explode(F.coalesce(lengths.scalar(), F.array().cast("array<int>"))))
        .filter(F.col("length") <= F.length("path"))
        .withColumn("prefix", F.call_function("left", F.col("path"), F.col("length")))
        .filter(
            may_contain(
                bloom_words(pairs, "key", words).scalar(),
                F.concat_ws("\n", "suffix", "prefix"),
                words,
            )
        )
    )
    listed = rules.select(F.col("host").alias("suffix"), F.col("path").alias("prefix"), "action")
    best = (
        hits.join(listed, ["suffix", "prefix"])
        .groupBy("host", "path")
        .agg(
            F.max(
                F.struct(
                    (F.length("suffix") + F.length("prefix")).alias("n"),
                    F.length("suffix").alias("h"),
                    F.concat("suffix", "prefix").alias("rule"),
                    "action",
                )
            ).alias("best")
        )
    )
    name = fresh("best", judged.columns)
    best = best.withColumnRenamed("best", name)
    return (
        judged.drop("rule", "verdict")
        .join(best, ["host", "path"], "left")
        .select(
            *[c for c in judged.columns if c not in ("rule", "verdict")],
            F.col(f"{name}.rule").alias("rule"),
            F.coalesce(f"{name}.action", F.lit(default)).alias("verdict"),
        )
    )
