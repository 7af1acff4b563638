"""URL filter, BPE, packing, WARC and nearest neighbours against exact references."""

import base64
import gzip
import hashlib
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from typerank.llm import ann, bpe, packing, urls, warc

PAGES = "page_id long, url string, html string, host string, verdict string"


def judged(table, addresses, f=urls.UrlFilter()):
    rows = [(i, u, "", "clash", "clash") for i, u in enumerate(addresses)]
    got = urls.judge_urls(table(rows, PAGES), f=f)
    assert got.columns == ["page_id", "url", "html", "host", "path", "rule", "verdict", "strict_hits", "soft_hits"]
    return {r.url if r.url is not None else r.page_id: r for r in got.collect()}


def test_rules_and_parts_of_a_url(table):
    got = judged(table, [
        "http://WWW.Example.com/en/1?q#t", "http://example.com/en/1", "http://a.example.com/EN/", "http://com", "http://example.com",
        "http://xcom/", "https://a.net/es/x#y", "https://a.net/de/", "a.net/es/", "", "x://b.net?/es/", "http://a://b.com/p",
    ])
    want = {
        "http://WWW.Example.com/en/1?q#t": ("www.example.com", "/en/1", "www.example.com/en/", "allow"),
        "http://example.com/en/1": ("example.com", "/en/1", "example.com/en/", "block"),
        "http://a.example.com/EN/": ("a.example.com", "/EN/", "com/", "allow"),
        "http://com": ("com", "", None, "allow"),
        "http://example.com": ("example.com", "", None, "allow"),
        "http://xcom/": ("xcom", "/", None, "allow"),
        "https://a.net/es/x#y": ("a.net", "/es/x", "net/es/", "block"),
        "https://a.net/de/": ("a.net", "/de/", None, "allow"),
        "a.net/es/": ("", "", None, "allow"),
        "": ("", "", None, "allow"),
        "x://b.net?/es/": ("b.net", "", None, "allow"),
        "http://a://b.com/p": ("a:", "//b.com/p", None, "allow"),
    }
    assert {u: (r.host, r.path, r.rule, r.verdict) for u, r in got.items()} == want


def test_vocabulary_with_boundaries(table):
    got = judged(table, [
        "http://free.org/", "http://free-bets.org/", "http://free.org/FREE", "http://xxx.org", "http://xxxl.org", "http://a.org/porn?",
        "http://freebets.org", "http://bets.org/bets-bet", None,
    ])
    hits = {u: (r.strict_hits, r.soft_hits, r.verdict) for u, r in got.items()}
    assert hits == {
        "http://free.org/": (0, 1, "allow"), "http://free-bets.org/": (0, 2, "block"), "http://free.org/FREE": (0, 1, "allow"),
        "http://xxx.org": (1, 0, "block"), "http://xxxl.org": (0, 0, "allow"), "http://a.org/porn?": (1, 0, "block"),
        "http://freebets.org": (0, 0, "allow"), "http://bets.org/bets-bet": (0, 2, "block"), 8: (0, 0, "allow"),
    }


def test_vocabulary_from_a_table(table, monkeypatch):
    terms = table([("Bad", True), ("bad", False), ("odd", None), ("Few", False), ("", True), (None, True)], "term string, strict boolean")
    f = urls.from_table(terms)
    assert (f.strict, f.soft, f.rules) == (("bad",), ("few", "odd"), urls.RULES)
    got = judged(table, ["x://a.org/BAD", "x://a.org/odd-few", "x://a.org/odd", "x://a.org/porn"], f)
    assert {u: r.verdict for u, r in got.items()} == {
        "x://a.org/BAD": "block", "x://a.org/odd-few": "block", "x://a.org/odd": "allow", "x://a.org/porn": "allow",
    }
    monkeypatch.setattr(urls, "MOST_TERMS", 2)
    with pytest.raises(ValueError, match="more than 2 terms"):
        urls.from_table(terms)


def test_filter_without_rules_or_terms(table):
    got = judged(table, ["http://xxx.net/es/"], urls.UrlFilter(rules=(), strict=(), soft=()))
    assert got["http://xxx.net/es/"].verdict == "allow"


def reference_encoding():
    import tiktoken

    v = bpe.public_vocabulary()
    with open(v.path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=v.pattern, mergeable_ranks=ranks, special_tokens={})


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(max_size=60), st.text("ab 's\n1é日<|>", max_size=40)), max_size=5))
def test_bpe_equals_the_reference(texts):
    v = bpe.public_vocabulary()
    coded = [np.frombuffer(x, np.int32) for x in bpe._coder(v).encode(texts)]
    assert [x.tolist() for x in coded] == [reference_encoding().encode_ordinary(t or "") for t in texts]
    if coded:
        back = bpe._decoder(v).decode(np.concatenate(coded), np.array([len(x) for x in coded]))
        assert back == [(t or "").encode() for t in texts]


def test_bpe_forgets_words_without_changing_results(monkeypatch):
    monkeypatch.setattr(bpe, "KEPT_WORDS", 3)
    monkeypatch.setattr(bpe, "QUERY_WORDS", 2)
    coder = bpe._Coder(bpe.public_vocabulary())
    for text in ("alpha betagamma zzqq", "zzqq deltaeps wqwq", "alpha wqwq"):
        (got,) = coder.encode([text])
        assert np.frombuffer(got, np.int32).tolist() == reference_encoding().encode_ordinary(text)


def test_bpe_round_trip_of_a_table(table):
    texts = ["Hello wörld", None, "", "a" * 300, "x y " * 9000, "Hello wörld"]
    docs = table([(i, t, "e", "clash") for i, t in enumerate(texts)], "doc_id long, text string, lang string, ids string")
    v = bpe.public_vocabulary()
    coded = bpe.encode(docs, v)
    rows = {r.doc_id: r for r in bpe.decode(coded, v).collect()}
    enc = reference_encoding()
    for i, t in enumerate(texts):
        assert rows[i].ids == enc.encode_ordinary(t or "") and bytes(rows[i].decoded) == (t or "").encode()
    got = {r.doc_id: r for r in bpe.round_trip(docs, v).collect()}
    assert got[0].ids_sha256 == hashlib.sha256(",".join(map(str, rows[0].ids)).encode()).hexdigest()
    assert got[1].decoded_sha256 == hashlib.sha256(b"").hexdigest() and got[1].n_tokens == 0
    assert bpe.round_trip(docs.limit(0), v).count() == 0


def test_unknown_ids_are_an_error(table):
    rows = table([([1, 10**6],)], "ids array<int>", 1)
    with pytest.raises(Exception, match="not in the vocabulary"):
        bpe.decode(rows, bpe.public_vocabulary()).collect()


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text("abé ß1.\n'", max_size=40), st.text(max_size=40)), min_size=1, max_size=5))
def test_fast_ids_equal_the_tokenizer(texts):
    import pyarrow as pa
    from tokenizers import Tokenizer

    t = packing.public_tokens()
    exact = Tokenizer.from_file(t.path)
    exact.encode_special_tokens = True
    want = [[*exact.encode(x or "", add_special_tokens=False).ids, 1] for x in texts]
    assert [x.tolist() for x in packing.token_ids(pa.array(texts, pa.string()), t)] == want


def test_added_tokens_in_texts_have_their_own_ids(table):
    import pyarrow as pa
    from tokenizers import Tokenizer

    t = packing.public_tokens()
    exact, end = Tokenizer.from_file(t.path), "<|endoftext|>"
    texts = [f"one {end} two", end, f"é{end}{end} ß", f"漢字 {end}\n{end}a", "<|endoftext|", f"x<|{end}|>", None, "plain"]
    want = [[*exact.encode(x or "", add_special_tokens=False).ids, 1] for x in texts]
    assert want[0] == [505, 220, 50256, 734, 1]
    assert [x.tolist() for x in packing.token_ids(pa.array(texts, pa.string()), t)] == want
    rows = packing.pack(table(list(enumerate(texts)), "doc_id long, text string", 1), t).collect()
    assert {r.doc_id: r.doc_tokens for r in rows} == {i: len(w) for i, w in enumerate(want)}
    assert all(r.ids_crc32 == zlib.crc32(np.array(want[r.doc_id], "<u4").tobytes()) for r in rows if r.length == r.doc_tokens)


def test_sum_of_squares_takes_the_best_level():
    packer = packing.Packer(16, 0)
    ids = np.arange(16, dtype="<u4")
    for n in (5, 5, 5):
        packer.place([n, 0, ids[:n], n])
    # A second window of 5 costs 3; on top of the first one it costs nothing.
    assert packer.counts[[5, 10, 15]].tolist() in ([1, 1, 0], [0, 0, 1])
    for n in (7, 3, 9, 2, 11, 1, 1, 6, 8, 13):
        before, expected = packer.counts.copy(), []
        for level in [0, *np.flatnonzero(before)]:
            if level + n <= 16:
                after = before.copy()
                if level:
                    after[level] -= 1
                if level + n < 16:
                    after[level + n] += 1
                expected.append((after**2).sum())
        packer.place([n, 0, ids[:n], n])
        assert (packer.counts**2).sum() == min(expected)


def test_packed_pieces_hold_every_id_once(table):
    texts = ["", None, "one two", "word " * 5000, *(f"t{i} " * (i * 7 % 900) for i in range(120))]
    docs = table([(i, t, 0, 0) for i, t in enumerate(texts)], "doc_id long, text string, start long, offset long")
    tokens = packing.public_tokens()
    rows = packing.pack(docs, tokens).toPandas().sort_values(["doc_id", "start"])
    import pyarrow as pa

    for i, own in rows.groupby("doc_id"):
        (ids,), at = packing.token_ids(pa.array([texts[i]], pa.string()), tokens), 0
        for r in own.itertuples():
            assert (r.start, r.doc_tokens) == (at, len(ids))
            at += r.length
            assert r.ids_crc32 == zlib.crc32(ids[r.start : at].tobytes())
        assert at == len(ids)
    windows = rows.sort_values("offset").groupby("sequence_id")
    for _, w in windows:
        assert w.offset.tolist() == [0, *w.length.cumsum().tolist()[:-1]]
        total = int(w.length.sum())
        assert total == 2048 or total & (total - 1) == 0
    assert sorted(rows.doc_id.unique()) == list(range(len(texts)))
    assert packing.pack(docs.limit(0), tokens).count() == 0


def page_rows():
    long, other = "é" * 600, "x" * 1000
    html = [long, "short", long, other, "short", None, "", other, long, "y" * 3_000_000]
    rows = [(i, f"http://a/{i}" if i else None, h, "h", "v") for i, h in enumerate(html)]
    return rows + [(8, "http://again/\r\nX: y", long, "h", "v"), (None, "u", long, "h", "v")]


def test_archives_round_trip(table):
    rows = page_rows()
    got = warc.round_trip(table(rows, PAGES)).collect()
    payload = [((r[2] or "").encode(), r[0]) for r in rows]
    last = {}
    for body, i in payload:
        if len(body) >= 1000:
            last[body] = max(last.get(body, -1), -1 if i is None else i)
    want = sorted(
        (repr(i), len(b), hashlib.sha1(b).hexdigest(), "revisit" if last.get(b, i) != i else "response", last[b] if last.get(b, i) != i else None)
        for b, i in payload
    )
    assert sorted((repr(r.page_id), r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got) == want
    assert warc.round_trip(table(rows, PAGES).limit(0)).count() == 0


def members(n=6):
    sha1 = lambda b: hashlib.sha1(b).hexdigest()
    bodies = [f"body {i} WARC/1.1\r\n".encode() * 50 for i in range(n)]
    return bodies, [warc.record(i, "u", b, None, sha1(b)) for i, b in enumerate(bodies)]


def ids(found):
    return [row["record_id"] for kind, _, _, _, row in found if kind == "record"]


@pytest.mark.parametrize("packed", [True, False])
def test_salvage_goes_on_after_damage(packed):
    bodies, records = members()
    parts = [gzip.compress(r) for r in records] if packed else records
    data, starts = b"".join(parts), np.cumsum([0, *map(len, parts)])
    whole = list(warc.salvage(data))
    assert ids(whole) == [f"<urn:page:{i}>" for i in range(6)] and [r[4]["payload"] for r in whole] == bodies
    broken = bytearray(data)
    middle = (starts[2] + starts[3]) // 2
    broken[middle : middle + 4] = b"\x00\x01\x02\x03"
    found = list(warc.salvage(bytes(broken)))
    assert [i for i in ids(found) if i != "<urn:page:2>"] == [f"<urn:page:{i}>" for i in (0, 1, 3, 4, 5)]
    assert "<urn:page:2>" not in ids(found)
    gaps = [(start, start + length) for kind, start, length, _, _ in found if kind == "gap"]
    assert gaps == [(starts[2], starts[3])]


def test_salvage_of_cut_and_foreign_bytes():
    _, records = members(3)
    parts = [gzip.compress(r) for r in records]
    found = list(warc.salvage(b"junk" + parts[0] + b"\x1f\x8b\x08junk" + parts[1] + parts[2][:-30]))
    assert ids(found) == ["<urn:page:0>", "<urn:page:1>"]
    assert [(k, n) for k, _, n, _, _ in found if k == "gap"] == [("gap", 4), ("gap", 7), ("gap", len(parts[2]) - 30)]
    assert list(warc.salvage(b"")) == []
    assert [x[0] for x in warc.salvage(b"nothing")] == ["gap"]


def test_archive_files_are_plain_gzip(table, tmp_path, spark):
    path = str(tmp_path / "archive")
    warc.write_archives(table(page_rows(), PAGES), path)
    text = b"".join(gzip.decompress(f.read_bytes()) for f in (tmp_path / "archive").glob("part-*"))
    assert text.count(b"WARC-Type: ") == len(page_rows())
    for f in list((tmp_path / "archive").glob("part-*"))[:1]:
        data = bytearray(f.read_bytes())
        data[len(data) // 2] ^= 255
        (tmp_path / "archive" / f".{f.name}.crc").unlink(missing_ok=True)
        f.write_bytes(bytes(data))
    rows = warc.read_archives(spark, path).groupBy("kind").count().collect()
    assert {r.kind for r in rows} == {"record", "gap"}


VECTORS = "vec_id long, embedding array<float>, label int, rank int"


def plain_nearest(rows, k):
    x = {i: np.asarray(v, dtype=np.float32).astype(float) for i, v in rows}
    out = {}
    for q in x:
        if q % 20 == 0:
            other = sorted(((-(x[q] * x[i]).sum(), i) for i in x if i != q))[:k]
            out[q] = [i for _, i in other]
    return out


def test_nearest_neighbours_recall_and_order(table):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(900, 16)) * rng.uniform(0.2, 3, size=(900, 1))
    x[300:600] = 10 * x[300] / np.linalg.norm(x[300])
    rows = [(i, v.tolist(), 0, 0) for i, v in enumerate(x)]
    odd = [(9000, None, 0, 0), (9020, [0.0] * 16, 0, 0), (9040, [float("nan")] * 16, 0, 0), (9060, [None] * 16, 0, 0), (9080, [1.0] * 3, 0, 0), (None, [1.0] * 16, 0, 0)]
    got = ann.nearest(table(rows + odd + rows[:30], VECTORS), "id % 20 = 0").collect()
    want, found = plain_nearest([(i, v) for i, v, _, _ in rows], 20), {}
    for r in sorted(got, key=lambda r: r.rank):
        found.setdefault(r.query_id, []).append(r.vec_id)
    assert set(found) == set(want) and all(len(v) == 20 for v in found.values())
    hit = sum(len(set(found[q]) & set(want[q])) for q in want) / (20 * len(want))
    assert hit >= 0.9
    # Equal vectors tie exactly, and the smaller ids come first.
    assert found[320] == want[320] == [i for i in range(300, 321) if i != 320]
    x32 = x.astype(np.float32).astype(float)
    for r in got:
        assert r.score == pytest.approx((x32[r.query_id] * x32[r.vec_id]).sum(), abs=1e-12)


@pytest.mark.parametrize("n", [0, 1, 2, 15])
def test_fewer_vectors_than_neighbours(table, n):
    rng = np.random.default_rng(n)
    rows = [(i, rng.normal(size=4).tolist(), 0, 0) for i in range(n)]
    got = ann.nearest(table(rows, VECTORS), "id % 20 = 0").collect()
    assert [r.vec_id for r in sorted(got, key=lambda r: r.rank)] == (plain_nearest([r[:2] for r in rows], 20).get(0, []))


def test_large_groups_of_equal_vectors_take_little_memory():
    import tracemalloc

    rng = np.random.default_rng(2)
    x = rng.normal(size=(1500, 64))
    x[:1200] = x[0]
    ids = rng.permutation(1500).astype(np.int64)
    tracemalloc.start()
    found = list(ann._met(ids, x, ids, x, 20))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    # All pairs of equal vectors would take 1200 * 1200 * 64 doubles, 737 MB.
    assert peak < 250e6
    query, other, score = (np.concatenate(c) for c in zip(*found))
    for i in (ids[3], ids[700], ids[1400]):
        own = x[ids == i][0]
        want = sorted((-(own * v).sum(), o) for v, o in zip(x, ids) if o != i)[:20]
        at = query == i
        assert list(other[at]) == [o for _, o in want] and np.allclose(score[at], [-s for s, _ in want])


def test_archives_of_any_file_name_are_read(table, spark, tmp_path):
    path, other = tmp_path / "ours", tmp_path / "foreign" / "segment"
    warc.write_archives(table(page_rows(), PAGES), str(path))
    other.mkdir(parents=True)
    for i, part in enumerate(sorted(path.glob("part-*"))):
        (other / f"CC-MAIN-{i}.warc.gz").write_bytes(part.read_bytes())
    plain = warc.record(99, "u", b"plain", None, hashlib.sha1(b"plain").hexdigest())
    (other / "loose.warc").write_bytes(plain)
    one = warc.read_archives(spark, str(path)).where("kind = 'record'")
    two = warc.read_archives(spark, str(tmp_path / "foreign")).where("kind = 'record'")
    key = ["record_id", "payload_digest"]
    assert two.count() == one.count() + 1
    assert sorted(map(tuple, one.select(key).collect()), key=repr) == sorted(
        map(tuple, two.where("record_id != '<urn:page:99>'").select(key).collect()), key=repr
    )


def test_files_have_a_bounded_number_of_records(table, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "FILE_RECORDS", 4)
    rows = [(i, "u", f"text {i}", "h", "v") for i in range(21)]
    warc.write_archives(table(rows, PAGES, 1), str(tmp_path / "a"))
    files = list((tmp_path / "a").glob("part-*"))
    assert len(files) == 6


def test_a_payload_of_most_pages_is_split(table, spark, capsys):
    """With more digests than are sent to the pages, the planner divides a hot payload."""
    names = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "32KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    rng = np.random.default_rng(1)
    hot = rng.integers(0, 1 << 62, 200).tobytes().hex()
    rows = [(i, "u", hot if i % 3 == 0 else rng.integers(0, 1 << 62, 80).tobytes().hex(), "h", "v") for i in range(3000)]
    pages = table(rows, PAGES, 8)
    before = {n: spark.conf.get(n, None) for n in names}
    try:
        for n, v in names.items():
            spark.conf.set(n, v)
        from pyspark.sql import functions as F

        total = warc.marked_pages(pages).agg(F.count("refers_to"), F.max("payload"), F.max("sha1"), F.max("url"))
        assert total.collect()[0][0] == 999
        capsys.readouterr()
        total.explain()
        assert "SortMergeJoin(skew=true)" in capsys.readouterr().out
    finally:
        for n, v in before.items():
            spark.conf.unset(n) if v is None else spark.conf.set(n, v)


def test_vectors_that_differ_are_not_sorted_as_wholes(monkeypatch):
    """Only where a block may hold equal vectors are they looked for; k is exact either way."""
    rng = np.random.default_rng(6)
    x, q = rng.normal(size=(900, 16)), rng.normal(size=(7, 16))
    ids, own = rng.permutation(900).astype(np.int64), np.array([2000, 2001, 2002, 3, 4, 5, 6])
    calls, best = [], ann._best
    monkeypatch.setattr(ann, "_best", lambda *a: calls.append(a) or best(*a))
    query, other, score = (np.concatenate(c) for c in zip(*ann._met(own, q, ids, x, 20)))
    assert len(calls) == 1
    for i, v in zip(own, q):
        want = sorted((-(v * w).sum(), o) for w, o in zip(x, ids) if o != i)[:20]
        assert list(other[query == i]) == [o for _, o in want]


@pytest.mark.parametrize("parts", [1, 3])
def test_small_rows_of_a_cell_are_put_together(spark, monkeypatch, parts):
    """Up to the size of a block; no vector is lost, and a key is dealt to several tasks."""
    monkeypatch.setattr(ann, "BLOCK", 4)
    blob = lambda *v, of: np.array(v, of).tobytes()
    rows = [(k, blob(10 * k + i, of=np.int64), blob(float(k), float(i), of=np.float64)) for k in range(3) for i in range(7)]
    listed = spark.createDataFrame(rows, ann._CELLS).repartition(5)
    got = ann._merged(listed, parts).collect()
    assert sorted(x for r in got for x in np.frombuffer(r.ids, np.int64)) == [10 * k + i for k in range(3) for i in range(7)]
    for r in got:
        ids, x = np.frombuffer(r.ids, np.int64), np.frombuffer(r.vectors, np.float64).reshape(-1, 2)
        assert len(ids) <= 4 and [(10 * a + b) for a, b in x] == list(ids) and {i // 10 for i in ids} == {r.key}
    assert len(got) == 6 if parts == 1 else 6 <= len(got) <= 3 * 4
