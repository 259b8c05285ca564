"""Document fingerprints: Merkle trees over leaves, paragraphs and sections.

Everything here is built from DataFrame functions. A document's lines are its
paragraphs, ``SECTION`` paragraphs in a row a section. A paragraph is cut into leaves
after words that their own hash picks, about one in five, so that a change moves no
cut but those beside it. A leaf's node is the MD5 of its text, a
paragraph's the SHA-256 of its leaves' nodes in order, a section's that of its
paragraphs' nodes, the root that of the sections' nodes; the root is the fingerprint.

Edits are located from the root down: sections that differ, and in these the
paragraphs that differ. Likeness counts the nodes of all levels that two trees share,
as often as both have them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulseforge.llm.common import written

SECTION = 16
#: Leaves end after words whose MD5 begins with a lesser digit.
CUT = "3"
#: A word with the blank after it, or a blank; longer words are cut.
TOKEN = "[^ ]{0,63}[^ ] ?| "


def _sha(parts: Column) -> Column:
    return F.sha2(F.concat_ws("", parts).cast("binary"), 256)


def leaves(text: Column) -> Column:
    """The nodes of each paragraph's leaves: an array for each paragraph. A paragraph
    has one leaf at least, which may be empty."""

    def ended(token: Column) -> Column:
        cut = F.md5(token.cast("binary")) < CUT
        return F.when(cut, F.concat(token, F.lit("\n"))).otherwise(token)

    def cut(line: Column) -> Column:
        marked = F.concat_ws("", F.transform(F.regexp_extract_all(line, F.lit(TOKEN), F.lit(0)), ended))
        return F.transform(F.split(F.rtrim(marked, F.lit("\n")), "\n", -1), lambda leaf: F.md5(leaf.cast("binary")))

    return F.transform(F.split(text, "\n", -1), cut)


def paragraphs(leaves_: Column) -> Column:
    """The paragraphs' nodes over their leaves' nodes."""
    return F.transform(leaves_, _sha)


def sections(paragraphs: Column) -> Column:
    """The sections' nodes over the paragraphs' nodes."""
    starts = F.sequence(F.lit(1), F.size(paragraphs), F.lit(SECTION))
    return F.transform(starts, lambda i: _sha(F.slice(paragraphs, i, SECTION)))


def root(sections_: Column) -> Column:
    return _sha(sections_)


def nodes(leaves_: Column, paragraphs_: Column, sections_: Column) -> Column:
    """Hashes of all nodes of a tree, sorted, each as often as it stands."""
    every = F.concat(F.flatten(leaves_), paragraphs_, sections_, F.array(root(sections_)))
    return F.sort_array(F.transform(every, lambda x: F.xxhash64(x)))


def likeness(a: Column, b: Column) -> Column:
    """Twice the nodes that two trees share over the nodes of both, 0 to 1; 1 only for
    equal trees. The sorted lists are merged step by step."""
    step = lambda i, j, n: F.struct(i.alias("i"), j.alias("j"), n.alias("n"))

    def merge(at: Column, _: Column) -> Column:
        i, j, n = at["i"], at["j"], at["n"]
        x, y = F.get(a, i), F.get(b, j)
        return F.when((i >= F.size(a)) | (j >= F.size(b)), at).when(x == y, step(i + 1, j + 1, n + 1)).when(x < y, step(i + 1, j, n)).otherwise(step(i, j + 1, n))

    both = F.size(a) + F.size(b)
    shared = F.aggregate(F.sequence(F.lit(1), both), step(F.lit(0), F.lit(0), F.lit(0)), merge, lambda at: at["n"])
    return 2.0 * shared / both


def differences(a: Column, b: Column) -> Column:
    """The places (from 0) at which two lists of nodes differ."""
    places = F.sequence(F.lit(0), F.greatest(F.size(a), F.size(b)) - 1)
    return F.filter(places, lambda i: ~F.get(a, i).eqNullSafe(F.get(b, i)))


def differences_below(above: Column, a: Column, b: Column) -> Column:
    """The places at which paragraphs differ, looked for in the sections ``above``."""
    most = F.greatest(F.size(a), F.size(b))

    def inside(s: Column) -> Column:
        places = F.sequence(s * SECTION, F.least((s + 1) * SECTION, most) - 1)
        return F.filter(places, lambda i: ~F.get(a, i).eqNullSafe(F.get(b, i)))

    return F.flatten(F.transform(above, inside))


def next_ids(docs: DataFrame) -> DataFrame:
    """(``_id``, ``_next``) for each distinct doc_id: the next larger one, after
    the largest the smallest.

    Ids are range-partitioned and the partition of each is written down; inside a
    partition the next id is a window away, and a partition's last id takes the
    first of the next partition (one row per partition).
    """
    ids = docs.select(F.col("doc_id").alias("_id")).where("_id is not null").distinct()
    placed = written(ids.repartitionByRange("_id").withColumn("_part", F.spark_partition_id()), "ids")
    firsts = placed.groupBy("_part").agg(F.min("_id").alias("_first"))
    least = F.min("_first").over(Window.partitionBy())
    after = F.lead("_first").over(Window.orderBy("_part"))
    firsts = firsts.select("_part", F.coalesce(after, least).alias("_after"))
    inside = F.lead("_id").over(Window.partitionBy("_part").orderBy("_id"))
    rows = placed.withColumn("_inside", inside).join(firsts, "_part")
    return rows.select("_id", F.coalesce("_inside", "_after").alias("_next"))


def edited(text: Column, other: Column) -> Column:
    """``text`` with its last floor(n/2) code points replaced by the first as many
    (or all) of ``other``."""
    n = F.length(text)
    half = F.floor(n / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), (n - half).cast("int")), F.substring(other, F.lit(1), half))


def compare_with_next(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited text, and their likeness.

    Columns: ``doc_id``; ``n_chars``; ``edited_sha256``; ``fingerprint``,
    ``edited_fingerprint`` (roots: equal texts have equal ones); ``near_edited``,
    ``near_next`` (likeness of the trees); ``edit_sections``, ``edit_paragraphs`` (all
    that the edit touches, from 0, joined by commas). A null text is empty. The
    next document is the one with the next larger doc_id; where rows share an id,
    the next is the least of their texts; a row without id is followed by the
    document with the least. One document is its own next. Extra columns are
    left out; an empty table gives no rows.
    """
    order = next_ids(docs).withColumnRenamed("_id", "_before")
    last = docs.agg(F.max("doc_id")).first()[0]
    # Each text is shuffled twice: by its own id, and on to the document before it.
    # A row without id stands with the last document, whose next is the least one.
    key = F.coalesce(F.col("doc_id"), F.lit(last), F.lit(0)).alias("_id")
    rows = docs.select("doc_id", key, F.coalesce(F.col("text"), F.lit("")).alias("text"))
    least = Window.partitionBy("_id").orderBy("_none", "other")
    others = rows.hint("merge").join(order, F.col("_id") == F.col("_next"))
    others = others.select(F.col("_before").alias("_id"), F.col("doc_id").isNull().alias("_none"), F.col("text").alias("other"))
    others = others.withColumn("_n", F.row_number().over(least)).where("_n = 1").select("_id", "other")
    rows = rows.hint("merge").join(others, "_id", "left").select("doc_id", "text", F.coalesce("other", F.lit("")).alias("other"))
    rows = rows.withColumn("edited", edited(F.col("text"), F.col("other")))
    names = ("text", "edited", "other")
    rows = rows.withColumns({f"_l_{n}": leaves(F.col(n)) for n in names})
    rows = rows.withColumns({f"_p_{n}": paragraphs(F.col(f"_l_{n}")) for n in names})
    rows = rows.withColumns({f"_s_{n}": sections(F.col(f"_p_{n}")) for n in names})
    rows = rows.withColumns({f"_n_{n}": nodes(F.col(f"_l_{n}"), F.col(f"_p_{n}"), F.col(f"_s_{n}")) for n in names})
    rows = rows.withColumn("_edits", differences(F.col("_s_text"), F.col("_s_edited")))
    listed = lambda places: F.concat_ws(",", places.cast("array<string>"))
    return rows.select(
        "doc_id", F.length("text").cast("long").alias("n_chars"), F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        root(F.col("_s_text")).alias("fingerprint"), root(F.col("_s_edited")).alias("edited_fingerprint"),
        likeness(F.col("_n_text"), F.col("_n_edited")).alias("near_edited"), likeness(F.col("_n_text"), F.col("_n_other")).alias("near_next"),
        listed(F.col("_edits")).alias("edit_sections"),
        listed(differences_below(F.col("_edits"), F.col("_p_text"), F.col("_p_edited"))).alias("edit_paragraphs"),
    )


def op9_merkle_fingerprints(spark, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and of their edited texts."""
    return compare_with_next(spark.read.parquet(f"{sf_dir}/documents.parquet"))
