"""Document fingerprints: a Merkle tree over sections, paragraphs and word blocks.

Sections are parted by blank lines (``\\n\\n``), paragraphs by line ends, blocks are runs of
``BLOCK_WORDS`` space-parted words. Every split keeps all characters, so roots are equal
exactly when texts are (up to SHA-256). Hash of a block: its text; of an inner node: its
children's hashes, tagged by level. Column expressions only.

Null counts as the empty text (one empty block). Rows with equal id and text are one entry of
the document order and all get its result; equal ids with different texts follow each other by
digest; null ids come first. The last document's next one is the first; a single document is
its own next. Very long texts are one row each, whole. Extra columns are not read, whatever their names. An
empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sylvan.llm.common import pick
from sylvan.operators.ordered import with_next, write_ranged
from sylvan.session import write_table

BLOCK_WORDS = 8
#: Hex digits of a block hash that the likeness compares (equality is the root's, in full).
TAG_DIGITS = 16


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once."""
    return F.transform(F.array(value), body)[0]


def block_hashes(paragraph: Column) -> Column:
    def of(words: Column) -> Column:
        starts = F.sequence(F.lit(1), F.size(words), F.lit(BLOCK_WORDS))
        return F.transform(starts, lambda i: F.sha2(F.array_join(F.slice(words, i, BLOCK_WORDS), " "), 256))

    return let(F.split(paragraph, " "), of)


def tree(text: Column) -> Column:
    """array (sections) of array (paragraphs) of array (blocks) of hashes."""
    return F.transform(
        F.split(F.coalesce(text, F.lit("")), "\n\n"),
        lambda section: F.transform(F.split(section, "\n"), block_hashes),
    )


def _node(level: str, children: Column) -> Column:
    return F.sha2(F.concat(F.lit(level), F.array_join(children, "")), 256)


def paragraph_hashes(section: Column) -> Column:
    return F.transform(section, lambda p: _node("p", p))


def section_hashes(tree_col: Column) -> Column:
    return F.transform(tree_col, lambda s: _node("s", paragraph_hashes(s)))


def root(tree_col: Column) -> Column:
    return _node("r", section_hashes(tree_col))


def block_tags(tree_col: Column) -> Column:
    """The distinct block hashes of a tree, shortened."""
    return F.array_distinct(F.transform(F.flatten(F.flatten(tree_col)), lambda h: F.substring(h, 1, TAG_DIGITS)))


def n_blocks(tree_col: Column) -> Column:
    """The leaves of a tree, repeats included."""
    return F.size(F.flatten(F.flatten(tree_col)))


def likeness(a: tuple[Column, Column, Column], b: tuple[Column, Column, Column]) -> Column:
    """Of two trees as (root, tags, leaves): 1 for equal roots, and for those alone.

    Else the smaller of two shares (2 x common / sum of both): of the distinct blocks, and of the leaves, so
    that repeats count; trees of the same blocks in another order stay one leaf's share below 1."""
    (root_a, tags_a, n_a), (root_b, tags_b, n_b) = a, b
    common = F.size(F.array_intersect(tags_a, tags_b))
    blocks = 2.0 * common / (F.size(tags_a) + F.size(tags_b))
    leaves = 2.0 * F.least(n_a, n_b) / (n_a + n_b)
    return F.when(root_a == root_b, F.lit(1.0)).otherwise(F.least(blocks, leaves, 1.0 - 1.0 / (n_a + n_b)))


def sections_of(tree_col: Column, blocks: bool = True) -> Column:
    """The inner nodes of a tree: sections of (hash, paragraphs (hash[, blocks]))."""
    paragraph = lambda p: F.struct(_node("p", p).alias("hash"), *([p.alias("blocks")] if blocks else []))
    section = lambda s: F.struct(
        _node("s", paragraph_hashes(s)).alias("hash"), F.transform(s, paragraph).alias("paragraphs")
    )
    return F.transform(tree_col, section)


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, root, sections``: the whole tree, as sections of (hash, paragraphs (hash, blocks))."""
    t = pick(df, doc_id=id_col, text=text_col).withColumn("tree", tree(F.col("text")))
    return t.select("doc_id", root(F.col("tree")).alias("root"), sections_of(F.col("tree")).alias("sections"))


def locate_edits(a: Column, b: Column) -> Column:
    """Where two ``sections`` columns differ: array of (section, paragraph) numbers from 0.

    Descends only into sections whose hashes differ; a section or paragraph that one side
    lacks counts as different.
    """

    def count(x: Column, y: Column) -> Column:
        return F.greatest(F.coalesce(F.size(x), F.lit(0)), F.coalesce(F.size(y), F.lit(0)), F.lit(0))

    def numbers(n: Column) -> Column:
        return F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))

    def differing(x: Column, y: Column) -> Column:
        return F.filter(numbers(count(x, y)), lambda i: ~F.get(x, i)["hash"].eqNullSafe(F.get(y, i)["hash"]))

    def inside(i: Column) -> Column:
        pa, pb = F.get(a, i)["paragraphs"], F.get(b, i)["paragraphs"]
        return F.transform(differing(pa, pb), lambda j: F.struct(i.alias("section"), j.alias("paragraph")))

    return F.flatten(F.transform(differing(a, b), inside))


def compare_with_successor(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each document against its edited text (second half replaced by the beginning of the next
    document) and against the next document, in ascending id order; where the edit lies is found by
    descending only differing sections (``n_edited_paragraphs``; ``first_edit``: section:paragraph from 0).

    The order is found on 32-byte keys. Texts are shuffled once by key (both readers share that
    exchange); the next document sends only the prefix that the edit takes, and its block tags.
    """
    docs = pick(df, doc_id=id_col, text=text_col)
    text = F.coalesce("text", F.lit(""))
    name = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.lit(":"), F.sha2(text, 256))
    rows = docs.select(F.unhex(F.sha2(name, 256)).alias("k"), "doc_id", text.alias("text"))
    entries = rows.groupBy("k").agg(
        F.first("doc_id").alias("doc_id"), F.first(F.length("text")).alias("n"), F.count(F.lit(1)).alias("copies")
    )
    ranged = write_ranged(entries, ["doc_id", "k"], "fingerprint-order")
    links = write_table(
        with_next(ranged, ["k"]).select("next_k", F.col("k").alias("prev_k"), (F.col("n") / 2).cast("int").alias("need")),
        "fingerprint-links",
    )
    repeated = ranged.filter("copies > 1").limit(1).count() > 0

    given = rows.join(links.hint("shuffle_hash"), rows["k"] == links["next_k"])
    given = given.select("prev_k", "need", F.col("doc_id").alias("next_doc_id"), "text", tree(F.col("text")).alias("tree"))
    given = given.select(
        "prev_k",
        "next_doc_id",
        F.substring(F.col("text"), F.lit(1), F.col("need")).alias("taken"),
        root(F.col("tree")).alias("next_root"),
        block_tags(F.col("tree")).alias("next_tags"),
        n_blocks(F.col("tree")).alias("next_leaves"),
    )
    if repeated:  # one donor for each entry; without repeated rows there is nothing to drop
        given = given.dropDuplicates(["prev_k"])
    both = rows.join(given, rows["k"] == given["prev_k"])
    n = F.length("text")
    kept = n - (n / 2).cast("int")
    both = both.select(
        "doc_id", n.cast("bigint").alias("n_chars"), "next_doc_id", "next_root", "next_tags", "next_leaves",
        tree(F.col("text")).alias("tree"),
        F.concat(F.substring(F.col("text"), F.lit(1), kept), F.col("taken")).alias("edited"),
    )
    both = both.withColumn("edited_tree", tree(F.col("edited")))
    # each side's inner nodes are hashed once, whatever looks at them
    old, new = sections_of(F.col("tree"), blocks=False), sections_of(F.col("edited_tree"), blocks=False)
    edits = let(old, lambda a: let(new, lambda b: locate_edits(a, b)))
    both = both.select(
        "doc_id", "n_chars", "next_doc_id", "next_root", "next_tags", "next_leaves",
        F.sha2("edited", 256).alias("edited_sha256"),
        root(F.col("tree")).alias("fingerprint"), block_tags(F.col("tree")).alias("tags"), n_blocks(F.col("tree")).alias("leaves"),
        root(F.col("edited_tree")).alias("edited_fingerprint"), block_tags(F.col("edited_tree")).alias("edited_tags"),
        n_blocks(F.col("edited_tree")).alias("edited_leaves"),
        let(edits, lambda e: F.struct(F.size(e).alias("n"), F.get(e, F.lit(0)).alias("first"))).alias("edits"),
    )
    side = lambda *names: tuple(F.col(n) for n in names)
    own = side("fingerprint", "tags", "leaves")
    first = F.concat(F.col("edits.first.section").cast("string"), F.lit(":"), F.col("edits.first.paragraph").cast("string"))
    return both.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        "fingerprint",
        "edited_fingerprint",
        likeness(own, side("edited_fingerprint", "edited_tags", "edited_leaves")).alias("near_edited"),
        likeness(own, side("next_root", "next_tags", "next_leaves")).alias("near_next"),
        "next_doc_id",
        F.col("edits.n").cast("bigint").alias("n_edited_paragraphs"),
        first.alias("first_edit"),
    )
