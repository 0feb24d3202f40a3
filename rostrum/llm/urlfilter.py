"""URL rules through a blocked Bloom filter and an exact hash join; DataFrame functions only.

A rule is a host and a path prefix. A url's candidate rules are its host and every parent domain, each with the first characters
of its path as long as some rule's path. The filter says which candidates may be listed; only those are joined with the list,
which removes what the filter let through by mistake; urls without a possible hit leave their tasks judged, and are never shuffled.
The longest listed rule decides; a url that no rule fits is allowed.

The filter has blocks of 512 bits, BITS_A_RULE bits for every rule, and a rule sets BITS bits of one block, so that a test touches
one block. It goes along as one literal of the plan, up to MAX_BLOCKS blocks (16 MB, over eight million rules); a longer list
still has all its rules in the filter, which then lets more through to the join. The list itself is joined by broadcast if it is
short by count, else by shuffle, where AQE splits skewed keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import within

#: Bits a rule sets, bits of the filter a rule gets, and blocks at most (64 bytes each).
BITS, BITS_A_RULE, MAX_BLOCKS = 4, 16, 1 << 18
#: Words of 64 bits in a block.
WORDS = 8
#: Rules that are broadcast at most, about 100 bytes each.
BROADCAST_RULES = 200_000


def url_host(url: Column) -> Column:
    """What stands after the first :// up to /, ?, # or the end, A-Z lower-cased; empty without ://."""
    rest = F.substring_index(url, "://", 1)
    after = F.substring(url, F.length(rest) + 4, F.length(url))
    host = F.regexp_extract(after, r"(?s)^[^/?#]*", 0)
    return F.when(F.coalesce(F.locate("://", url), F.lit(0)) > 0, F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")).otherwise(F.lit(""))


def url_path(url: Column) -> Column:
    """What stands after the host up to ?, # or the end; empty without ://."""
    rest = F.substring_index(url, "://", 1)
    after = F.substring(url, F.length(rest) + 4, F.length(url))
    return F.when(F.coalesce(F.locate("://", url), F.lit(0)) > 0, F.regexp_extract(after, r"(?s)^[^/?#]*([^?#]*)", 1)).otherwise(F.lit(""))


def _bits(key: Column, blocks: int) -> tuple[Column, list[Column]]:
    """The block of a key, and the bits in it."""
    h, g = F.xxhash64(key), F.xxhash64(key, F.lit(1))
    return F.pmod(h, F.lit(blocks)), [F.pmod(F.shiftright(g, 9 * i), F.lit(512)) for i in range(BITS)]


class BlockedBloom:
    """The words of a blocked Bloom filter over the keys of a DataFrame's column."""

    def __init__(self, keys: DataFrame, column: str):
        n = keys.count()
        self.blocks = max(1, min(MAX_BLOCKS, -(-n * BITS_A_RULE // 512)))
        block, bits = _bits(F.col(column), self.blocks)
        set_bits = keys.select(block.alias("block"), F.explode(F.array(*bits)).alias("bit"))
        word = (F.col("block") * WORDS + F.shiftright("bit", 6)).cast("int").alias("word")
        rows = set_bits.select(word, F.expr("shiftleft(1L, cast(bit % 64 as int))").alias("mask")).groupBy("word").agg(F.bit_or("mask").alias("mask"))
        # the words in order, as one string of 16 hexadecimal digits each: MAX_BLOCKS * WORDS at most
        every = keys.sparkSession.range(self.blocks * WORDS).join(rows, F.col("id") == F.col("word"), "left")
        text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("id", F.coalesce("mask", F.lit(0).cast("long")).alias("mask")))), lambda x: x["mask"].cast("string")), ",")
        self.words = every.agg(text.alias("words")).first().words

    def may_have(self, key: Column) -> Column:
        """False only for keys that are not listed."""
        # of constants, so the optimiser makes it one array before any row is read
        words = F.split(F.lit(self.words), ",").cast("array<long>")
        block, bits = _bits(key, self.blocks)
        out = F.lit(True)
        for bit in bits:
            word = F.get(words, (block * WORDS + F.shiftright(bit, 6)).cast("int"))
            out = out & (F.call_function("shiftrightunsigned", word, (bit % 64).cast("int")).bitwiseAND(F.lit(1)) == 1)
        return out


def candidates(lengths: list[int], longest: int) -> Column:
    """Keys (and their host lengths) of the columns host and path: each parent domain of at most so many characters, with each so long a start of the path."""
    labels = F.split("host", r"\.", -1)
    parents = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels) - i + 1), "."))
    parents = F.filter(parents, lambda h: (h != "") & (F.length(h) <= longest))
    starts = F.filter(F.array(*[F.lit(n) for n in lengths]), lambda n: n <= F.length("path"))
    return F.flatten(F.transform(parents, lambda h: F.transform(starts, lambda n: F.struct(F.concat(h, F.substring(F.col("path"), F.lit(1), n)).alias("key"), F.length(h).alias("host_length")))))


def judge(pages: DataFrame, rules: DataFrame, *, default: str = "allow", id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """page_id, host, path, rule and verdict of every row of pages; rules has host, path and verdict.

    A rule fits its host and all subdomains if the url's path starts with the rule's. Of several, the longest (host and path
    together) wins; of equally long ones the longer host, of repeated ones "block" before others. A rule of an empty path fits all paths. A null url or one
    without :// has empty host and path and fits no rule. Repeated rows give a row each. Rules of a null host, path or verdict are left out.
    Other columns of pages are not read.
    """
    r = rules.where("host IS NOT NULL AND path IS NOT NULL AND verdict IS NOT NULL AND host <> ''")
    r = r.groupBy(F.concat("host", "path").alias("key"), F.length("host").alias("host_length")).agg(F.min_by("verdict", F.struct(F.col("verdict") != "block", F.col("verdict"))).alias("listed"))
    shape = r.agg(F.array_sort(F.collect_set(F.length("key") - F.col("host_length"))).alias("paths"), F.max("host_length").alias("host")).first()
    p = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"))
    p = p.select("page_id", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path"))
    best = F.lit(None).cast("struct<rule:string,verdict:string>").alias("best")
    if not shape.paths:
        found = p.select("page_id", "host", "path", best)
    else:
        bloom = BlockedBloom(r, "key")
        p = p.withColumn("possible", F.filter(candidates(shape.paths, shape.host), lambda x: bloom.may_have(x["key"])))
        clear = p.where(F.size("possible") == 0).select("page_id", "host", "path", best)
        # a number for every row, made before any shuffle, keeps repeated rows apart
        tried = p.where(F.size("possible") > 0).withColumn("row", F.monotonically_increasing_id()).select("row", "page_id", "host", "path", F.explode("possible").alias("x"))
        met = tried.select("row", "page_id", "host", "path", "x.key", "x.host_length").join(F.broadcast(r) if within(r, BROADCAST_RULES) else r, ["key", "host_length"], "left")
        rank = F.struct(F.length("key"), F.col("host_length"))
        longest = F.max_by(F.struct(F.col("key").alias("rule"), F.col("listed").alias("verdict")), F.when(F.col("listed").isNotNull(), rank))
        found = met.groupBy("row", "page_id", "host", "path").agg(longest.alias("best")).drop("row").unionByName(clear)
    listed = F.col("best.verdict").isNotNull()
    return found.select("page_id", "host", "path", F.when(listed, F.col("best.rule")).alias("rule"), F.when(listed, F.col("best.verdict")).otherwise(F.lit(default)).alias("verdict"))
