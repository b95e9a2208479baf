import hashlib

from pyspark.sql import functions as F

from sylvan.llm import fixity, merkle
from sylvan.llm.queries import damaged, op3_merkle_fingerprint, op6_warc_fixity
from sylvan.session import write_table


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def brute_tree(text):
    out = []
    for section in (text or "").split("\n\n"):
        paragraphs = []
        for p in section.split("\n"):
            w = p.split(" ")
            paragraphs.append([sha(" ".join(w[i : i + 8])) for i in range(0, len(w), 8)])
        out.append(paragraphs)
    return out


def brute_root(tree):
    return sha("r" + "".join(sha("s" + "".join(sha("p" + "".join(p)) for p in s)) for s in tree))


def brute_like(a, b):
    if a == b:
        return 1.0
    x, y = ([h[:16] for s in brute_tree(t) for p in s for h in p] for t in (a, b))
    leaves = len(x) + len(y)
    return min(2.0 * len(set(x) & set(y)) / (len(set(x)) + len(set(y))), 2.0 * min(len(x), len(y)) / leaves, 1.0 - 1.0 / leaves)


def brute_edits(a, b):
    """Paragraphs that differ, compared place by place."""
    x, y = ([s.split("\n") for s in t.split("\n\n")] for t in (a, b))
    out = []
    for i in range(max(len(x), len(y))):
        p, q = (z[i] if i < len(z) else [] for z in (x, y))
        out += [f"{i}:{j}" for j in range(max(len(p), len(q))) if p[j : j + 1] != q[j : j + 1]]
    return len(out), out[0] if out else None


def brute(entries):
    """entries: (id, text) in document order, distinct."""
    for k, (i, t) in enumerate(entries):
        nxt = entries[(k + 1) % len(entries)][1]
        half = len(t) // 2
        edited = t[: len(t) - half] + nxt[:half]
        likes = brute_like(t, edited), brute_like(t, nxt)
        yield (i, len(t), sha(edited), brute_root(brute_tree(t)), brute_root(brute_tree(edited)), *likes, *brute_edits(t, edited))


COLS = (
    "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "n_edited_paragraphs", "first_edit",
)


def test_likeness_is_one_for_equal_roots_alone(spark):
    texts = ["a\n" * 1000, "a\n", "a\nb", "b\na", "a b", "a\n"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r.doc_id: r.near_next for r in merkle.compare_with_successor(df).collect()}
    assert got[0] < 0.01 and got[2] == 0.75 and got[5] < 0.01 and all(x < 1 for x in got.values())


def test_query_against_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    entries = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect())
    df = op3_merkle_fingerprint(spark, sf)
    assert sorted(tuple(r[c] for c in COLS) for r in df.collect()) == list(brute(entries))
    plan = df._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_odd_rows(spark, docs, rows, empty):
    def key(i, t):
        return (i is not None, i, hashlib.sha256(f"{'null' if i is None else i}:{sha(t)}".encode()).digest())

    entries = sorted({(i, t or "") for i, t, _ in rows}, key=lambda r: key(*r))
    want = {(r[0], r[3]): r for r in brute(entries)}
    got = [tuple(r[c] for c in COLS) for r in merkle.compare_with_successor(docs).collect()]
    assert len(got) == len(rows)
    assert all(r == want[r[0], r[3]] for r in got)
    one = docs.filter("doc_id = 1")
    assert [(r.near_next, r.near_edited < 1) for r in merkle.compare_with_successor(one).collect()] == [(1.0, True)]
    assert merkle.compare_with_successor(empty).count() == 0


def test_edits_are_located(spark):
    a = "one two\nthree\n\nfour\nfive\n\nsix"
    cases = {a: [], a.replace("five", "5"): [(1, 1)], a.replace("two", "2").replace("six", "6"): [(0, 0), (2, 0)],
             a + "\nseven": [(2, 1)], "one two\nthree\n\nfour\nfive": [(2, 0)], None: [(0, 0), (0, 1), (1, 0), (1, 1), (2, 0)]}
    df = spark.createDataFrame([(i, a, b) for i, b in enumerate(cases)], "i long, a string, b string")
    fa = merkle.fingerprints(df, "i", "a").select("doc_id", F.col("sections").alias("x"), F.col("root").alias("rx"))
    fb = merkle.fingerprints(df, "i", "b").select("doc_id", F.col("sections").alias("y"), F.col("root").alias("ry"))
    got = fa.join(fb, "doc_id").select("doc_id", "rx", "ry", merkle.locate_edits(F.col("x"), F.col("y")).alias("edits"))
    for r in got.collect():
        want = list(cases.values())[r.doc_id]
        assert [tuple(e) for e in r.edits] == want and (r.rx == r.ry) == (not want)


def test_audit_finds_planted_damage(spark):
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet")
    got = op6_warc_fixity(spark, "/root/testdata/sf0.1")
    rows = {r.page_id: r for r in got.collect()}
    assert len(rows) == pages.count()
    assert {i for i, r in rows.items() if r.status == "missing"} == {i for i in rows if i % 389 == 5}
    assert {i for i, r in rows.items() if r.status == "corrupt"} == {i for i in rows if i % 97 == 13 and i % 389 != 5}
    at = 0
    for _, r in sorted(rows.items()):
        assert r.segment * fixity.SEGMENT_BYTES + r.offset == at
        at += r.length


def test_records_and_roots(spark):
    pages = [(1, "http://a/", "<p>é</p>"), (2, None, None), (None, "u", ""), (2, None, None)]
    df = spark.createDataFrame([(*p, 7, 8) for p in pages], "page_id long, url string, html string, pos long, digest int")
    got = fixity.write_archive(df)
    want = []
    for i, u, h in sorted(pages, key=lambda p: (p[0] is not None, p[0])):
        body = (h or "").encode()
        head = f"WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:{'' if i is None else i}>\r\nWARC-Target-URI: {u or ''}\r\nContent-Type: text/html\r\nContent-Length: {len(body)}\r\n\r\n"
        want.append(head.encode() + body + b"\r\n\r\n")
    rows = sorted(got.collect(), key=lambda r: r.pos)
    assert [(r.length, r.digest) for r in rows] == [(len(w), hashlib.sha256(w).hexdigest()) for w in want]
    level = fixity.merkle_levels(got)
    assert len(level) == 1
    lines = "\n".join(f"{r.pos}:{r.digest}" for r in rows)
    assert [(r["at"], r.digest) for r in level[0].collect()] == [(0, sha(lines))]


def test_audit_of_unequal_archives(spark):
    a = spark.range(4000).select((F.col("id") * 900).alias("pos"), F.lit(900).alias("length"), F.md5(F.col("id").cast("string")).alias("digest"))
    b = a.filter("pos < 1800000 or pos = 3000600").withColumn("digest", F.when(F.col("pos") == 900, "x").otherwise(F.col("digest")))
    b = b.union(spark.createDataFrame([(5_000_000, 900, "more")], b.schema))
    got = {r.pos: r.status for r in fixity.audit(a, b).collect()}
    want = {p * 900: "missing" for p in range(2000, 4000) if p * 900 != 3000600} | {900: "corrupt", 5_000_000: "extra"}
    assert got == want
    assert fixity.audit(a, a).count() == 0
    none = a.filter("pos < 0")
    assert fixity.audit(none, none).count() == 0
    assert fixity.audit(a, none).filter("status = 'missing'").count() == 4000


def test_shifted_records_are_found(spark):
    """Two archives laid out on their own: what follows a lost, longer or added record is intact."""
    pages = [(i, f"u{i}", f"page {i} " * 300) for i in range(300)] + [(7, "u7", "page 7 " * 300)] * 2 + [(None, None, None)]
    held = [p for p in pages if p[0] != 3]
    held[held.index((7, "u7", "page 7 " * 300))] = (7, "u7", "other")
    held.remove((7, "u7", "page 7 " * 300))
    held = [(p[0], p[1], p[2] + "longer") if p[0] == 50 else p for p in held] + [(400, "u400", "new"), (20, "v", "new")]
    schema = "page_id long, url string, html string"
    segments = fixity.write_segments(spark.createDataFrame(pages, schema))
    assert all(r.record.startswith("WARC/1.0") and r.record.endswith("\r\n\r\n") for r in segments.collect())
    a, b = fixity.read_archive(segments), fixity.write_archive(spark.createDataFrame(held, schema))
    got = sorted((r.page_id, r.url, r.status) for r in fixity.audit_records(a, b).collect())
    want = [(3, "u3", "missing"), (7, "u7", "corrupt"), (7, "u7", "missing"), (20, "v", "extra"), (50, "u50", "corrupt"), (400, "u400", "extra")]
    assert got == want
    assert fixity.audit_records(a, a).count() == 0


SCHEMA = "page_id long, url string, html string"


def _ranges(records):
    """Brute force: what each range of an archive holds, by the name of its stretch and its place there."""
    out, name, start, last = {}, "", 0, None
    for r in sorted(records.collect(), key=lambda r: r.pos):
        key = sha(f"{'' if r.page_id is None else r.page_id}\n{r.url or ''}")[:16]
        if key != last and key.endswith("0"):
            name, start = key, r.pos
        last = key
        assert (r.names[0], r.start) == (name, start)
        out.setdefault((name, (r.pos - start) // fixity.RANGE_BYTES), []).append((r.pos - start, r.digest))
    return out


def _check(a, b):
    bad, visited = fixity.descend(a, b)
    bad = {(r.name, r["sub"]) for r in bad.collect()}
    x, y = _ranges(a), _ranges(b)
    assert bad == {k for k in x.keys() | y.keys() if x.get(k) != y.get(k)}
    return bad, [v.count() for v in visited], len(x)


def test_descent_visits_what_differs_only(spark):
    """A lost first record moves every offset, yet alters the ranges of one or two stretches."""
    pages = spark.range(6000).selectExpr("id page_id", "concat('u', id) url", "repeat(concat('page ', id, ' '), 200) html")
    segments = fixity.write_segments(pages)
    a = write_table(fixity.read_archive(segments), "a")
    for lost in (0, 3000):
        copied = fixity.copy_segments(segments, lambda p, lost=lost: p.filter(f"page_id <> {lost}"))
        b = write_table(fixity.read_archive(copied), "b")
        bad, visited, n = _check(a, b)
        assert 1 <= len(bad) <= 4 and n > 300
        assert sum(visited) < n // 3, visited
        assert [(r.page_id, r.status) for r in fixity.audit_records(a, b).collect()] == [(lost, "missing")]
    bad, visited, _ = _check(a, a)
    assert not bad and visited[0] == 1 and sum(visited) == 1


def test_descent_of_a_lost_border_copies_long_and_odd_rows(spark):
    """Lost borders join stretches; copies open none, so one stretch of copies has many ranges; a
    page above RANGE_BYTES, null pages and no page at all."""
    keys = [i for i in range(200) if sha(f"{i}\nu")[:16].endswith("0")]
    pages = [(i, "u", f"page {i} " * 100) for i in range(200)] + [(keys[0], "u", "copy " * 500)] * 700 + [(250, "u", "long " * 60_000), (None, None, None)]
    held = [p for p in pages if p[0] != keys[1] or p[2] is None]
    held.remove((keys[0], "u", "copy " * 500))
    segments = fixity.write_segments(spark.createDataFrame(pages, SCHEMA))
    a = write_table(fixity.read_archive(segments), "a")
    b = write_table(fixity.write_archive(spark.createDataFrame(held, SCHEMA)), "b")
    _check(a, b)
    got = sorted((r.page_id, r.status) for r in fixity.audit_records(a, b).collect())
    assert got == [(keys[0], "missing"), (keys[1], "missing")]
    none = write_table(fixity.write_archive(spark.createDataFrame([], SCHEMA)), "none")
    assert fixity.audit_records(none, none).count() == 0
    assert fixity.audit_records(a, none).filter("status = 'missing'").count() == len(pages)
    assert fixity.audit_records(none, a).filter("status = 'extra'").count() == len(pages)


def test_damaged_keeps_rows(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    assert damaged(pages).count() == pages.count()
