"""URL filter: a blocked Bloom filter before an exact hash join.

Built-in Spark expressions only. A listed rule is a canonical URL prefix, host
and path in one string such as ``example.org/es/``, with a verdict. It fits its
host and all subdomains whose path starts with its path; the longest rule wins.

A page URL has one *candidate* per rule shape (labels of the host, characters of
the path): its last labels and the start of its path. Candidates are looked up
in a Bloom filter whose blocks are one 64-bit word each, ``bits_per_rule`` bits
per listed URL and at most ``max_blocks`` words, so its size is bounded whatever
the list's; a longer list only lets more false hits pass. Only rows with a hit
are expanded and joined with the list, which removes false hits; rows without
one never leave their task. The join is an equi join on the rule text: the
planner broadcasts the list only below its own size threshold, and splits a key
that very many rows hit.

Defined cases: a null URL, or one without ``://``, has an empty host and path and
no rule; null and repeated ids are judged row by row; rules listed twice count
once, and block wins where they differ; an empty list allows all; an empty table
gives an empty result; further columns are ignored.
"""

from pyspark.sql import DataFrame, functions as F

BITS_PER_RULE = 16
MAX_BLOCKS = 1 << 17  # 1 MB of filter
SHAPE = 1 << 20  # a shape is labels * SHAPE + characters
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def add_parts(pages: DataFrame, url_column="url") -> DataFrame:
    """``pages`` with host and path of the URL."""
    rest = F.when(F.instr(url_column, "://") > 0, F.expr(f"substr(`{url_column}`, instr(`{url_column}`, '://') + 3)")).otherwise("")
    return pages.withColumn("_rest", F.coalesce(rest, F.lit(""))).withColumns({
        "host": F.translate(F.regexp_extract("_rest", r"^[^/?#]*", 0), UPPER, LOWER),
        "path": F.regexp_extract("_rest", r"(?s)^[^/?#]*(/[^?#]*)", 1),
    }).drop("_rest")


def _mask(key):
    """Four bits of a 64-bit word, from a hash that is independent of the block's."""
    h = F.xxhash64(key, F.lit("bits"))
    bits = [F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned(h, 6 * i).bitwiseAND(F.lit(63)).cast("int"))
            for i in range(4)]
    return bits[0].bitwiseOR(bits[1]).bitwiseOR(bits[2]).bitwiseOR(bits[3])


def _block(key, blocks: int):
    return F.pmod(F.xxhash64(key), F.lit(blocks)).cast("int")


def _numbers(values, kind="long"):
    """A literal array made from one string, which the optimizer folds into a constant."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast(f"array<{kind}>")


def bloom_filter(rules: DataFrame, blocks: int) -> list:
    """The filter as ``blocks`` 64-bit words; its size is bounded by ``max_blocks``, not by the list."""
    words = rules.groupBy(_block("rule", blocks).alias("block")).agg(F.bit_or(_mask("rule")).alias("word"))
    filled = dict(words.collect())
    return [filled.get(block, 0) for block in range(blocks)]


def judge(pages: DataFrame, rules: DataFrame, id_column="page_id", url_column="url",
          bits_per_rule=BITS_PER_RULE, max_blocks=MAX_BLOCKS) -> DataFrame:
    """page_id, host, path, rule (or null), verdict. ``rules`` has rule, verdict."""
    listed = rules.groupBy("rule").agg(F.max("verdict").alias("verdict"))  # 'block' sorts after 'allow'
    count = max(1, listed.count())
    blocks = min(max_blocks, max(1, -(-count * bits_per_rule // 64)))
    host = F.split_part(F.col("rule"), F.lit("/"), F.lit(1))
    # As many shapes as there are different label counts times path lengths in the list.
    shapes = [row.shape for row in listed.select(
        (F.size(F.split(host, "[.]")) * SHAPE + F.length("rule") - F.length(host)).alias("shape")).distinct().collect()]
    words = _numbers(bloom_filter(listed, blocks))
    parts = add_parts(pages.select(F.col(id_column).alias("page_id"), F.col(url_column).alias("url"))).drop("url")

    def candidate(shape):
        labels, chars = (shape / SHAPE).cast("int"), shape % SHAPE
        return F.concat(F.call_function("substring_index", F.col("host"), F.lit("."), -labels),
                        F.call_function("substring", F.col("path"), F.lit(1), chars))

    def possible(key):
        return F.get(words, _block(key, blocks)).bitwiseAND(_mask(key)) == _mask(key)

    fitting = F.filter(_numbers(shapes or [0], "int"), lambda shape: shape % SHAPE <= F.length("path"))
    hits = F.filter(F.transform(fitting, candidate), possible)
    marked = parts.withColumn("hits", F.coalesce(F.when(F.col("host") != "", F.array_distinct(hits)), F.array().cast("array<string>")))
    plain = marked.where(F.size("hits") == 0).select(
        "page_id", "host", "path", F.lit(None).cast("string").alias("rule"), F.lit("allow").alias("verdict"))
    rows = marked.where(F.size("hits") > 0).withColumn("_row", F.monotonically_increasing_id())
    exact = rows.select("_row", "page_id", "host", "path", F.explode("hits").alias("rule")).join(listed, "rule", "left")
    best = exact.groupBy("_row", "page_id", "host", "path").agg(F.max(F.when(
        F.col("verdict").isNotNull(), F.struct(F.length("rule").alias("length"), "rule", "verdict"))).alias("best"))
    return plain.unionByName(best.select(
        "page_id", "host", "path", "best.rule", F.coalesce("best.verdict", F.lit("allow")).alias("verdict")))
