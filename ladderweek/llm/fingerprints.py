"""SimHash fingerprints of documents from weighted terms, and a search for all within a Hamming radius.

Terms are pairs of neighbouring words (the last word alone); a term weighs a point per four characters, eight
at most. Every bit of a term's hash votes for or against that bit with the term's weight, and the sign decides. The
votes of four bits share a long, sixteen bits wide each; 4,095 terms at most are added up that way before they are
spread out, so that not even the upper one reaches the sign of the long and a text may be of any length. Only DataFrame
functions are used.

The search cuts the fingerprint into blocks and keeps one table per choice of blocks that must be equal: of
radius + m blocks, some m are equal in any two fingerprints within the radius. Tables are met by equality joins and the
distance is checked in the join. Equal fingerprints are searched once.

Neighbours in descending order of id are found without a global sort: ids fall into blocks of 512 numbers, each block
is one window, and only the first row of each block is handed to the block before.

Defined results: a NULL text is empty; a blank text has fingerprint zero; equal ids are ordered by text; NULL ids come
last; repeated rows are rows of their own; after the last row comes the first (a single row follows itself); an empty
table gives an empty one. Other columns of the input are not read.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ladderweek.llm.common import BLANKS, stored, text_or_empty

NO_ID = -(2**63)
SHIFT = 9
LANES = 0x0001000100010001
WEIGHT = 8
CHUNK = (2**15 - 1) // WEIGHT  # sums stay below 2 ** 15 each: the upper lane ends in the sign, and sums may not overflow


def likeness(a: Column, b: Column) -> Column:
    return 1 - F.bit_count(a.bitwiseXOR(b)) / F.lit(64.0)


def in_blocks(docs: DataFrame, id_col: str) -> DataFrame:
    number = F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), number.alias("number"), text_or_empty().alias("text"))
    return rows.withColumn("block", F.shiftright("number", SHIFT))


def next_heads(blocks: DataFrame) -> DataFrame:
    """(block, next_block): the block that follows in descending order, after the last the first."""
    upper = F.shiftright("block", SHIFT).alias("upper")
    tops = blocks.groupBy(upper).agg(F.max("block").alias("top"))
    order = Window.orderBy(F.desc("upper"))  # a row for 262,144 numbers
    first = F.max("top").over(Window.partitionBy())
    tops = tops.select("upper", F.coalesce(F.lead("top").over(order), first).alias("after"))
    own = F.lead("block").over(Window.partitionBy("upper").orderBy(F.desc("block")))
    return blocks.select("block", upper).withColumn("own", own).join(tops, "upper").select(
        "block", F.coalesce("own", "after").alias("next_block")
    )


def with_next_text(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(block, nth, doc_id, text, next_text), partitioned by block."""
    rows = in_blocks(docs, id_col)
    heads = stored(rows.groupBy("block").agg(F.max("number").alias("head")), "heads")
    follow = next_heads(heads)
    head_text = rows.join(heads.select(F.col("head").alias("number")), "number").groupBy("block").agg(
        F.min("text").alias("head_text")
    )
    after = follow.join(head_text.withColumnRenamed("block", "next_block"), "next_block")
    order = Window.partitionBy("block").orderBy(F.desc("number"), "text")
    placed = rows.withColumn("nth", F.row_number().over(order)).withColumn("in_block", F.lead("text").over(order))
    joined = placed.join(after.select("block", "head_text"), "block", "left")
    return joined.select("block", "nth", "doc_id", "text", F.coalesce("in_block", "head_text").alias("next_text"))


def edited_text(text: Column, other: Column) -> Column:
    """The last third of the code points replaced by as many first ones of another text."""
    third = F.floor(F.length(text) / 3).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.length(text) - third), F.substring(other, F.lit(1), third))


def votes(rows: DataFrame, text: str, keys: list[str]) -> DataFrame:
    """(keys, fingerprint) of the texts in column ``text``; keys tell rows apart."""
    words = F.split(F.btrim(F.col(text), F.lit(" \t\n\x0b\x0c\r")), BLANKS)
    pairs = F.arrays_zip(words.alias("a"), F.slice(words, F.lit(2), F.greatest(F.size(words) - 1, F.lit(0))).alias("b"))
    terms = rows.select(*keys, F.posexplode(pairs).alias("pos", "t")).select(
        *keys, F.floor(F.col("pos") / CHUNK).cast("int").alias("chunk"), F.col("t")["a"].alias("a"), F.col("t")["b"].alias("b")
    )
    length = F.length("a") + F.coalesce(F.length("b"), F.lit(0))
    weight = F.least(F.ceil(length / 4), F.lit(WEIGHT)).cast("long")
    terms = terms.select(*keys, "chunk", F.xxhash64("a", "b").alias("h"), weight.alias("w"))
    packed = terms.groupBy(*keys, "chunk").agg(
        F.sum("w").alias("total"),
        *[
            F.sum(F.shiftrightunsigned("h", c).bitwiseAND(F.lit(LANES)) * F.col("w")).alias(f"s{c}")
            for c in range(16)
        ],
    )
    lane = lambda bit: F.shiftrightunsigned(f"s{bit % 16}", bit // 16 * 16).bitwiseAND(F.lit(0xFFFF))
    spread = packed.groupBy(*keys).agg(
        F.sum("total").alias("total"), *[F.sum(lane(bit)).alias(f"v{bit}") for bit in range(64)]
    )
    fingerprint = F.lit(0).cast("long")
    for bit in range(64):
        value = F.shiftleft(F.lit(1).cast("long"), bit)
        fingerprint = fingerprint.bitwiseOR(F.when(2 * F.col(f"v{bit}") > F.col("total"), value).otherwise(F.lit(0)))
    return spread.select(*keys, fingerprint.alias("fingerprint"))


def fingerprint_pairs(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Per row: doc_id, n_chars, edited_sha256, fp, edited_fp and next_fp (longs)."""
    placed = with_next_text(docs, id_col)
    edited = placed.withColumn("edited", edited_text(F.col("text"), F.col("next_text")))
    both = F.array(
        F.struct(F.lit(0).alias("version"), F.col("text").alias("body")),
        F.struct(F.lit(1).alias("version"), F.col("edited").alias("body")),
    )
    rows = edited.select(
        "block",
        "nth",
        "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        F.unhex(F.sha2(F.encode("edited", "UTF-8"), 256)).alias("sha"),
        F.explode(both).alias("v"),
    ).select("block", "nth", "doc_id", "n_chars", "sha", "v.version", "v.body")
    keys = ["block", "nth", "doc_id", "n_chars", "sha"]
    each = votes(rows, "body", [*keys, "version"])
    of = lambda n: F.max(F.when(F.col("version") == n, F.col("fingerprint")))
    prints = stored(each.groupBy(*keys).agg(of(0).alias("fp"), of(1).alias("edited_fp")), "prints")
    heads = prints.where("nth = 1").select(F.col("block").alias("next_block"), F.col("fp").alias("head_fp"))
    after = next_heads(prints.select("block").distinct()).join(heads, "next_block").select("block", "head_fp")
    own = F.lead("fp").over(Window.partitionBy("block").orderBy("nth"))
    return prints.withColumn("own", own).join(after, "block", "left").select(
        "doc_id",
        "n_chars",
        F.lower(F.hex("sha")).alias("edited_sha256"),
        "fp",
        "edited_fp",
        F.coalesce("own", "head_fp").alias("next_fp"),
    )


def block_keys(fp: Column, blocks: int, equal: int) -> Column:
    """Array of (table, key): for every choice of ``equal`` blocks, the bits of these."""
    cuts = [64 * b // blocks for b in range(blocks + 1)]
    entries = []
    for number, chosen in enumerate(combinations(range(blocks), equal)):
        mask = sum(((1 << (cuts[b + 1] - cuts[b])) - 1) << cuts[b] for b in chosen)
        signed = mask - (1 << 64) if mask >> 63 else mask
        entries.append(F.struct(F.lit(number).alias("table"), fp.bitwiseAND(F.lit(signed).cast("long")).alias("key")))
    return F.array(*entries)


def within_radius(queries: DataFrame, prints: DataFrame, radius: int = 3, equal: int = 2) -> DataFrame:
    """(query_fp, fp, distance): all distinct fingerprints ``fp`` of ``prints`` within ``radius`` of those of ``queries``.

    Both have a column fp. There are radius + equal blocks and a table for each choice of ``equal`` of them; a pair
    that meets in several tables is kept in the first only.
    """
    blocks = radius + equal
    q = queries.select(F.col("fp").alias("query_fp")).distinct()
    p = prints.select("fp").distinct()
    left = q.select("query_fp", F.inline(block_keys(F.col("query_fp"), blocks, equal)))
    right = p.select("fp", F.inline(block_keys(F.col("fp"), blocks, equal)).alias("its_table", "its_key"))
    differ = F.col("query_fp").bitwiseXOR(F.col("fp"))
    same = (F.col("table") == F.col("its_table")) & (F.col("key") == F.col("its_key"))
    met = left.join(right, same & (F.bit_count(differ) <= radius))
    masks = F.transform(block_keys(F.lit(-1).cast("long"), blocks, equal), lambda e: e["key"])
    first = F.array_position(F.transform(masks, lambda m: differ.bitwiseAND(m) == 0), F.lit(True)) - 1
    return met.where(F.col("table") == first).select("query_fp", "fp", F.bit_count(differ).alias("distance"))


def near_counts(prints: DataFrame, every: int = 100, radius: int = 3) -> DataFrame:
    """(fp, near): for fingerprints of ids divisible by ``every``, how many rows lie within ``radius``, itself included."""
    sizes = prints.groupBy("fp").agg(F.count("*").alias("n"))
    queries = prints.where(F.col("doc_id") % every == 0).select("fp")
    found = within_radius(queries, prints, radius).join(sizes, "fp")
    return found.groupBy(F.col("query_fp").alias("fp")).agg(F.sum("n").alias("near"))
