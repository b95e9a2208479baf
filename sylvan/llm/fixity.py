"""WARC fixity audit by Merkle trees over records and ordered offset ranges.

An archive is a folder of segment files (Parquet) that hold the records' bytes in stream order. What
is audited is read from them: ``pos`` (byte offset in the whole stream), ``length`` and ``digest``,
hashed anew. Two replicas are compared from the root of their trees down: only children of
differing nodes are looked at, and in the end the records of differing leaf ranges.

``audit_records`` finds each record wherever it lies. A lost, added or longer record moves the
offsets of all that follows, so ranges start anew at records whose own name (digest of id and URL,
not of the payload) ends in a zero, one in ``FANOUT``: a stretch runs from one such border to the next, and
its ranges cover ``RANGE_BYTES`` of the offsets from its start. Names with more zeros part
the levels above, so nodes of both replicas meet by name. A lost record alters the ranges of one
stretch, or of two if it was a border; equal ranges hold equal records, so leaving them out changes
no count of copies. ``audit`` is for replicas that must agree byte for byte: its leaf
ranges cover ``RANGE_BYTES`` of the whole stream's offsets, each level above ``FANOUT`` ranges of the
one below, and it compares what lies at the same offset.

Null pages are empty payloads. Repeated records are records of their own, at their own
offsets, and open no stretch. Very long records are ranges of their own. Empty archives have no
node: two of them are equal. Extra columns are left out, whatever their names. DataFrame expressions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sylvan.llm.common import pick
from sylvan.operators.ordered import PID, POS, running_sums, write_ranged
from sylvan.session import shuffle_partitions, write_table

RANGE_BYTES = 64 << 10
FANOUT = 16
LEVELS = 8  # of stretches; a border of level n ends in n + 1 zeros
SEGMENT_BYTES = 1 << 30  # a WARC file of the stream; segment files hold less on average


def warc_record(page_id: Column, url: Column, html: Column) -> Column:
    """The bytes (as text) of a WARC response record; every header line ends in CRLF."""
    body = F.coalesce(html, F.lit(""))
    lines = [
        F.lit("WARC/1.0"),
        F.lit("WARC-Type: response"),
        F.concat(F.lit("WARC-Record-ID: <urn:page:"), F.coalesce(page_id.cast("string"), F.lit("")), F.lit(">")),
        F.concat(F.lit("WARC-Target-URI: "), F.coalesce(url, F.lit(""))),
        F.lit("Content-Type: text/html"),
        F.concat(F.lit("Content-Length: "), F.octet_length(body).cast("string")),
    ]
    return F.concat(F.concat_ws("\r\n", *lines), F.lit("\r\n\r\n"), body, F.lit("\r\n\r\n"))


def write_segments(df: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Writes the records' bytes into segment files, in ascending (id, url, digest) order: ``page_id,
    url, record``, ``head`` (characters before the payload; null without one), file and place."""
    pages = pick(df, page_id=id_col, url=url_col, html=html_col)
    record = warc_record(F.col("page_id"), F.col("url"), F.col("html"))
    made = pages.withColumn("record", record).withColumn("digest", F.sha2("record", 256))
    made = made.withColumn("head", F.length("record") - F.length("html") - 4).drop("html")
    total = pages.agg(F.sum(F.octet_length("html"))).first()[0] or 0
    parts = max(shuffle_partitions(df.sparkSession), 1 + 2 * total // SEGMENT_BYTES)
    return write_ranged(made, ["page_id", "url", "digest"], "warc-segments", parts, compression="zstd").drop("digest")


def copy_segments(segments: DataFrame, change) -> DataFrame:
    """Segment files of their own with what ``change`` makes of the pages ``(page_id, url, html, ...)``."""
    html = F.expr("substring(record, head + 1, length(record) - head - 4)")
    pages = change(segments.withColumn("html", html).drop("record"))
    record = warc_record(F.col("page_id"), F.col("url"), F.col("html"))
    return write_table(pages.withColumn("record", record).drop("html"), "warc-segments", compression="zstd")


def read_archive(segments: DataFrame) -> DataFrame:
    """Reads and hashes the records of segment files: ``page_id, url, pos, length, digest``, the
    ``names`` of the stretches that a record lies in, one per level, and the ``start`` of the lowest."""
    length = F.octet_length("record").cast("bigint").alias("length")
    named = F.concat_ws("\n", F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.coalesce("url", F.lit("")))
    key = F.substring(F.sha2(named, 256), 1, 16).alias("key")
    index = segments.select("page_id", "url", length, F.sha2("record", 256).alias("digest"), key, PID, POS)
    # a record opens a stretch only as the first of its name: repeated records do not
    ends = index.groupBy(F.col(PID).alias("part")).agg(F.max_by("key", POS).alias("last"))
    along = Window.orderBy("part")  # one row per written partition, here and below
    ends = ends.select("part", F.lag("last").over(along).alias("before"))
    rows = index.join(F.broadcast(ends), F.col(PID) == F.col("part")).drop("part")
    order = Window.partitionBy(PID).orderBy(POS)
    opens = ~F.col("key").eqNullSafe(F.coalesce(F.lag("key").over(order), "before"))
    rows = running_sums(rows.withColumn("opens", opens), {"pos": F.col("length")})
    marks = [F.when(F.col("opens") & F.col("key").endswith("0" * (n + 1)), F.struct("pos", "key")) for n in range(LEVELS)]
    rows = rows.select("*", *[m.alias(f"m{n}") for n, m in enumerate(marks)])
    lasts = rows.groupBy(F.col(PID).alias("part")).agg(*[F.max(f"m{n}").alias(f"l{n}") for n in range(LEVELS)])
    earlier = along.rowsBetween(Window.unboundedPreceding, -1)
    lasts = lasts.select("part", *[F.max(f"l{n}").over(earlier).alias(f"c{n}") for n in range(LEVELS)])
    sofar = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    none = F.struct(F.lit(0).cast("bigint").alias("pos"), F.lit("").alias("key"))
    rows = rows.join(F.broadcast(lasts), F.col(PID) == F.col("part"))
    rows = rows.select("*", *[F.coalesce(F.max(f"m{n}").over(sofar), f"c{n}", none).alias(f"s{n}") for n in range(LEVELS)])
    names = F.array(*[F.col(f"s{n}")["key"] for n in range(LEVELS)]).alias("names")
    return rows.select("page_id", "url", "pos", "length", "digest", F.col("s0")["pos"].alias("start"), names)


def write_archive(df: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Writes the segment files and reads them: ``page_id, url, pos, length, digest``."""
    return read_archive(write_segments(df, id_col, url_col, html_col))


def digest_of(children: Column) -> Column:
    """Digest of (number, digest) children, in order."""
    lines = F.transform(F.array_sort(children), lambda c: F.concat(c["at"].cast("string"), F.lit(":"), c["digest"]))
    return F.sha2(F.array_join(lines, "\n"), 256)


def merkle_levels(records: DataFrame) -> list[DataFrame]:
    """Written node tables ``at, digest`` from the leaf ranges to the root. A group has the records
    of one range or the children of one node: bounded by RANGE_BYTES and FANOUT."""
    leaf = F.floor(F.col("pos") / RANGE_BYTES).cast("bigint")
    child = F.struct(F.col("pos").alias("at"), "digest")
    nodes = write_table(records.groupBy(leaf.alias("at")).agg(digest_of(F.collect_list(child)).alias("digest")), "merkle-level")
    levels = [nodes]
    top = nodes.agg(F.max("at")).first()[0]
    while top:
        up = F.floor(F.col("at") / FANOUT).cast("bigint")
        child = F.struct("at", "digest")
        nodes = nodes.groupBy(up.alias("up")).agg(digest_of(F.collect_list(child)).alias("digest"))
        nodes = write_table(nodes.withColumnRenamed("up", "at"), "merkle-level")
        levels.append(nodes)
        top //= FANOUT
    return levels


def _differing(a: DataFrame, b: DataFrame) -> DataFrame:
    other = b.select(F.col("at").alias("b_at"), F.col("digest").alias("b_digest"))
    both = a.join(other, F.col("at") == F.col("b_at"), "full_outer")
    return both.filter(~F.col("digest").eqNullSafe(F.col("b_digest"))).select(F.coalesce("at", "b_at").alias("at"))


def _bad_ranges(a: DataFrame, b: DataFrame) -> DataFrame:
    """The numbers (``range``) of the leaf ranges in which two archives differ."""
    tree_a, tree_b = merkle_levels(a), merkle_levels(b)
    while len(tree_a) < len(tree_b):  # a shorter archive has fewer levels: its top stands for all
        tree_a.append(tree_a[-1])
    while len(tree_b) < len(tree_a):
        tree_b.append(tree_b[-1])
    bad = write_table(_differing(tree_a[-1], tree_b[-1]), "merkle-bad")
    for level_a, level_b in zip(tree_a[-2::-1], tree_b[-2::-1], strict=True):
        parents = bad.select(F.col("at").alias("parent"))
        inside = F.floor(F.col("at") / FANOUT).cast("bigint") == F.col("parent")
        below = [x.join(parents, inside, "left_semi") for x in (level_a, level_b)]
        bad = write_table(_differing(*below), "merkle-bad")
    return bad.select(F.col("at").alias("range"))


def in_range() -> list[Column]:
    """The range of a record: the lowest stretch that it lies in (``name``) and its place there (``sub``)."""
    sub = F.floor((F.col("pos") - F.col("start")) / RANGE_BYTES).cast("bigint")
    return [F.col("names")[0].alias("name"), sub.alias("sub")]


def range_tree(records: DataFrame, rounds: int, top: int) -> list[DataFrame]:
    """Written node tables ``name, sub, at, names, digest, up_name, up_sub`` from the ranges to the
    root: ``rounds`` levels join the ranges of a long stretch, ``top`` levels the stretches."""
    ups = [(F.col("names")[0], F.floor(F.col("sub") / FANOUT).cast("bigint"))] * rounds
    ups += [(F.col("names")[n], F.lit(0).cast("bigint")) for n in range(1, top + 1)]
    ups += [(F.lit(""), F.lit(0).cast("bigint"))]
    inside = F.struct((F.col("pos") - F.col("start")).alias("at"), "digest")
    nodes = records.select("*", *in_range()).groupBy("name", "sub")
    nodes = nodes.agg(F.min("pos").alias("at"), F.min("names").alias("names"), digest_of(F.collect_list(inside)).alias("digest"))
    levels = []
    for up_name, up_sub in ups:
        nodes = write_table(nodes.withColumns({"up_name": up_name, "up_sub": up_sub}), "merkle-level")
        levels.append(nodes)
        child = F.array_sort(F.collect_list(F.struct("at", "name", "sub", "digest")))
        lines = F.transform(child, lambda c: F.concat_ws(":", c["name"], c["sub"].cast("string"), c["digest"]))
        nodes = nodes.groupBy(F.col("up_name").alias("name"), F.col("up_sub").alias("sub"))
        nodes = nodes.agg(F.min("at").alias("at"), F.min("names").alias("names"), F.sha2(F.array_join(lines, "\n"), 256).alias("digest"))
    root = nodes.withColumns({"up_name": F.lit(""), "up_sub": F.lit(0).cast("bigint")})
    return [*levels, write_table(root, "merkle-level")]


def descend(a: DataFrame, b: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """The ranges (``name, sub``) in which two archives differ, and for every level from the root
    down the nodes that were compared (``name, sub, differs``): children of differing nodes only."""
    sizes = [x.agg(F.count(F.lit(1)), F.max(in_range()[1])).first() for x in (a, b)]
    n, longest = (max(x[i] or 0 for x in sizes) for i in (0, 1))
    rounds, top = 0, 0
    while FANOUT**rounds <= longest:
        rounds += 1
    while top < LEVELS - 1 and FANOUT ** (top + 2) <= n:
        top += 1
    trees = [range_tree(x, rounds, top)[::-1] for x in (a, b)]
    bad, visited = None, []
    for nodes in zip(*trees, strict=True):
        x, y = (t if bad is None else t.join(bad, (F.col("up_name") == F.col("b_name")) & (F.col("up_sub") == F.col("b_sub")), "left_semi") for t in nodes)
        other = y.select("name", "sub", F.col("digest").alias("other"))
        differs = ~F.col("digest").eqNullSafe(F.col("other"))
        both = x.join(other, ["name", "sub"], "full_outer").select("name", "sub", differs.alias("differs"))
        visited.append(write_table(both, "merkle-visited"))
        bad = visited[-1].filter("differs").select(F.col("name").alias("b_name"), F.col("sub").alias("b_sub"))
    return bad.select(F.col("b_name").alias("name"), F.col("b_sub").alias("sub")), visited


def audit(a: DataFrame, b: DataFrame) -> DataFrame:
    """``pos, status`` of every place in which the replicas ``(pos, length, digest)`` differ:
    ``corrupt`` (other bytes), ``missing`` (only in a) or ``extra`` (only in b)."""
    ranges = _bad_ranges(a, b)
    leaf = F.floor(F.col("pos") / RANGE_BYTES).cast("bigint") == F.col("range")
    ra, rb = (x.select("pos", "digest").join(ranges, leaf, "left_semi") for x in (a, b))
    rb = rb.select(F.col("pos").alias("b_pos"), F.col("digest").alias("b_digest"))
    both = ra.join(rb, F.col("pos") == F.col("b_pos"), "full_outer").filter(~F.col("digest").eqNullSafe(F.col("b_digest")))
    status = F.when(F.col("b_pos").isNull(), "missing").when(F.col("pos").isNull(), "extra").otherwise("corrupt")
    return both.select(F.coalesce("pos", "b_pos").alias("pos"), status.alias("status"))


def audit_records(a: DataFrame, b: DataFrame, ranges: DataFrame | None = None) -> DataFrame:
    """``page_id, url, pos, b_pos, status`` of every record in which two replicas (of ``read_archive``)
    differ, wherever it lies: ``corrupt`` (other bytes), ``missing`` (only in a) or
    ``extra`` (only in b; ``pos`` is null). Of equal records the last ones are the surplus.
    ``ranges``: what ``descend`` found, if it is at hand."""
    if ranges is None:
        ranges, _ = descend(a, b)
    cols = ["page_id", "url", "digest", "pos"]
    ra, rb = (x.select(*cols, *in_range(), F.lit(n).alias("in_a")).join(ranges, ["name", "sub"], "left_semi") for x, n in ((a, 1), (b, 0)))
    both = ra.unionByName(rb)
    counts = both.groupBy("page_id", "url", "digest").agg(F.sum("in_a").alias("na"), F.count(F.lit(1)).alias("n"))
    # counted before rows meet: only records with other numbers of copies are numbered
    odd = counts.filter("2 * na <> n").select(
        F.col("page_id").alias("o_id"), F.col("url").alias("o_url"), F.col("digest").alias("o_digest"), F.least("na", F.expr("n - na")).alias("paired")
    )
    odd = write_table(odd, "warc-odd")
    same = F.col("page_id").eqNullSafe(F.col("o_id")) & F.col("url").eqNullSafe(F.col("o_url")) & (F.col("digest") == F.col("o_digest"))
    number = F.row_number().over(Window.partitionBy("page_id", "url", "digest", "in_a").orderBy("pos"))
    left = both.join(odd, same).withColumn("k", number).filter("k > paired")
    left = left.withColumn("k", F.row_number().over(Window.partitionBy("page_id", "url", "in_a").orderBy("pos")))
    left = write_table(left.select("page_id", "url", "pos", "in_a", "k"), "warc-left")
    x = left.filter("in_a = 1").drop("in_a")
    y = left.filter("in_a = 0").select(F.col("page_id").alias("b_id"), F.col("url").alias("b_url"), F.col("pos").alias("b_pos"), F.col("k").alias("b_k"))
    pair = F.col("page_id").eqNullSafe(F.col("b_id")) & F.col("url").eqNullSafe(F.col("b_url")) & (F.col("k") == F.col("b_k"))
    status = F.when(F.col("b_pos").isNull(), "missing").when(F.col("pos").isNull(), "extra").otherwise("corrupt")
    named = [F.coalesce("page_id", "b_id").alias("page_id"), F.coalesce("url", "b_url").alias("url")]
    return x.join(y, pair, "full_outer").select(*named, "pos", "b_pos", status.alias("status"))
