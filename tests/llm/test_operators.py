"""Each operator against a brute-force version on odd rows, on an empty table, and against its contract's formulas."""

import collections
import hashlib
import io
import random
import re
import time
import zlib

import numpy as np
import pytest
import xxhash
from helpers import documents, odd_rows, words
from hypothesis import given, settings
from hypothesis import strategies as st

from quarrymill.llm import boosting, cdc, langid, media, mixing, packing, pii, prefix_forest, sharding, simhash, suffix_dedup
from quarrymill.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def rows():
    return odd_rows()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return documents(spark, rows).cache()


@pytest.fixture(scope="module")
def empty(docs):
    return docs.where("false")


def raw(text):
    return (text or "").encode()


# --- 1 media


def test_media_contract(docs, rows):
    got = collections.Counter(tuple(r)[:7] for r in media.media_features(docs).collect())
    want = collections.Counter()
    for doc_id, text, *_ in rows:
        b = raw(text)
        payload = b.ljust(max(1, -(-len(b) // 576)) * 576, b"\xff")
        stored = f"P5\n24 {len(payload) // 24}\n255\n".encode() + payload
        want[(doc_id, len(b), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]), len(stored), hashlib.sha256(stored).hexdigest())] += 1
    assert got == want


def test_media_bmp_and_empty(docs, empty):
    pick = ["doc_id", "payload_sha256", "feature"]
    assert sorted(map(repr, media.media_features(docs, "bmp").select(pick).collect())) == sorted(map(repr, media.media_features(docs).select(pick).collect()))
    assert media.media_features(empty).count() == 0


@settings(max_examples=40, deadline=None)
@given(st.integers(1, 20), st.integers(1, 20), st.sampled_from([(), (3,)]), st.randoms())
def test_image_round_trips(height, width, channels, rng):
    image = np.array([rng.randrange(256) for _ in range(height * width * (3 if channels else 1))], np.uint8).reshape(height, width, *channels)
    for encode in (media.encode_netpbm, media.encode_bmp):
        assert (media.decode(encode(image)) == image).all()


def test_plain_and_deep_netpbm():
    assert media.decode(b"P2 # c\n2 1 # d\n15\n15 0").tolist() == [[255, 0]]
    assert media.decode(b"P1\n3 2\n1 0 1\n011").tolist() == [[0, 255, 0], [255, 0, 0]]
    assert media.decode(b"P4\n3 1\n\xa0").tolist() == [[0, 255, 0]]
    assert media.decode(b"P5\n1 1\n65535\n\x80\x00").tolist() == [[127]]
    assert media.decode(b"P3\n1 1\n255\n1 2 3").tolist() == [[[1, 2, 3]]]
    for bad in (b"", b"P5\n9 9\n255\n12", b"P9 1 1", b"BM12", b"P2\n2"):
        with pytest.raises(ValueError):
            media.decode(bad)


def test_area_resize_is_the_exact_mean():
    rng = np.random.default_rng(1)
    image = rng.integers(0, 256, (7, 10))
    big = np.kron(image, np.ones((8 * 3, 9 * 2)))  # every source pixel in whole parts of each cell
    want = big.reshape(8, big.shape[0] // 8, 9, big.shape[1] // 9).mean(axis=(1, 3))
    assert np.allclose(media.area_resize(image, 8, 9), want)
    assert np.load(io.BytesIO(media.tile_of(image.astype(np.uint8))[0])).shape == (16, 16)
    tall = rng.integers(0, 256, (500, 24)).astype(np.uint8)
    for block in (1, 7, 64, 1000):  # blocks of rows make no difference
        assert all(np.allclose(a, b) for a, b in zip(media.area_resizes(tall, [(8, 9), (16, 16)], block), media.area_resizes(tall, [(8, 9), (16, 16)]), strict=True))
    for shape in ((1, 1), (3, 50), (50, 3)):
        assert np.allclose(media.area_resize(np.full(shape, 77, np.uint8), 16, 16), 77)


@settings(max_examples=300, deadline=None)
@given(st.one_of(st.binary(max_size=80), st.tuples(st.sampled_from([b"P1 ", b"P2 ", b"P3\n", b"P4 ", b"P5 ", b"P6 ", b"BM"]), st.text("0123456789 #\n", max_size=40)).map(lambda x: x[0] + x[1].encode()), st.binary(max_size=60).map(lambda x: b"BM" + x), st.binary(max_size=40).map(lambda x: media.encode_bmp(np.zeros((3, 3), np.uint8))[:40] + x)))
def test_decoders_raise_nothing_but_value_errors(blob):
    try:
        assert media.decode(blob).dtype == np.uint8
    except ValueError:
        pass


def test_tiles_survive_any_bytes(spark):
    bad = [b"P5 99999999999999999999 1 255\n", b"P2\n1 1\n255\n" + b"9" * 20, b"P5 2 2 0\n1234", b"P1 1 1\n9", b"P2 1 1 10\n11", b"P5 0 0 255\n", b"BM" + b"\xff" * 60, b"", None]
    good = [media.encode_netpbm(np.arange(600, dtype=np.uint8).reshape(300, 2)), media.encode_bmp(np.arange(600, dtype=np.uint8).reshape(300, 2))]
    rows = [(str(i), b) for i, b in enumerate(bad + good)]
    got = media.tiles(spark.createDataFrame(rows, "k string, m binary"), "k", "m").collect()
    assert sorted((r.key, r.tile) for r in got) == [("10", 0), ("10", 1), ("9", 0), ("9", 1)]
    assert {r.npy for r in got if r.key == "9"} == {r.npy for r in got if r.key == "10"}


def test_query_tiles_are_those_of_the_bmp_column(docs):
    """The registered features against tiles of a stored BMP column."""
    stored = media.tiles(media.media_column(docs.where("doc_id < 30"), "bmp"), "doc_id", "media").collect()
    hashes = collections.defaultdict(list)
    for r in sorted(stored, key=lambda r: r.tile):
        hashes[r.key].append((r.tile, r.dhash, bytes(r.npy)))
    for r in media.media_features(docs.where("doc_id < 30 AND doc_id NOT IN (8, 11)")).collect():
        own = hashes[str(r.doc_id)]
        assert r.n_tiles == len(own) and r.tile_hashes == ",".join(h for _, h, _ in own) and r.tiles_sha256 == hashlib.sha256(b"".join(n for *_, n in own)).hexdigest()


def test_tiles(spark, docs):
    stored = media.media_column(docs.where("doc_id in (7, 12)"))
    got = media.tiles(stored, "doc_id", "media").collect()
    assert len({(r.key, r.tile) for r in got}) == len(got) > 2 and all(np.load(io.BytesIO(r.npy)).shape == (16, 16) for r in got)
    assert media.tiles(spark.createDataFrame([("a", b"junk"), ("b", None)], "doc_id string, media binary"), "doc_id", "media").count() == 0


# --- 2 chunks


def slow_ends(b, reach=cdc.REACH):
    value = []
    for i in range(len(b)):
        h = 0
        for j in range(min(i + 1, 16)):
            h += int(cdc.GEAR[b[i - j]]) << j
        value.append(h % 2**32)
    ends = []
    for i in range(reach, len(b) - reach):
        around = value[i - reach : i + reach + 1]
        if value[i] == max(around) and around.index(value[i]) == reach:
            ends.append(i + 1)
    out = []
    for end in [e for e in ends if e < len(b)] + [len(b)] * bool(b):
        start = out[-1] if out else 0
        while end - start > cdc.MOST:
            start += cdc.MOST
            out.append(start)
        out.append(end)
    return out


def test_chunk_ends_match_the_definition_and_blocks():
    rng = random.Random(2)
    for n in (0, 1, 5, 60, 900):
        b = words(rng, n).encode()
        assert cdc.chunk_ends(b).tolist() == slow_ends(b)
        assert cdc.chunk_ends(b, block=128).tolist() == slow_ends(b)
    b = b"ab " * 500
    assert cdc.chunk_ends(b).tolist() == slow_ends(b)


def test_chunks_resist_insertions():
    rng = random.Random(3)
    b = words(rng, 2000).encode()
    changed = b[:3000] + b"something new " + b[3000:]
    before, after = ({d for *_, d in cdc.chunks(x)} for x in (b, changed))
    assert len(after - before) <= 5


def slow_chunk_dedup(rows, run):
    """Counter of (doc_id, n_repeated, kept_sha256, plain_repeated, plain_sha256): rows in the order of doc_id, one after
    the other, and equal rows in any order. Which of two different rows of one doc_id comes first is left open: `first`."""
    cut = [(doc_id, text, raw(text), cdc.chunks(raw(text))) for doc_id, text, *_ in rows]
    copies = collections.Counter(d for *_, own in cut for _, _, d in own)
    seen, out = set(), collections.Counter()
    for doc_id, text, b, own in sorted(cut, key=lambda x: (x[0] is None, x[0] or 0)):
        again = [copies[d] > 1 for _, _, d in own]
        kept, plain, repeated, fresh = [], [], 0, set()
        for n, (s, e, d) in enumerate(own):
            low = high = n
            while low >= 0 and again[low]:
                low -= 1
            while high < len(own) and again[high]:
                high += 1
            long = again[n] and own[high - 1][1] - own[low + 1][0] >= run
            repeated += (e - s) * long
            out_now = again[n] and d in seen | fresh
            kept += [] if out_now and long else [b[s:e]]
            plain += [] if out_now else [b[s:e]]
            fresh.add(d)
        seen |= fresh
        out[(doc_id, len(b), repeated, hashlib.sha256(b"".join(kept)).hexdigest(), sum(e - s for (s, e, _), x in zip(own, again, strict=True) if x), hashlib.sha256(b"".join(plain)).hexdigest())] += 1
    return out


@pytest.mark.parametrize("run", [cdc.RUN, 0])
def test_chunk_dedup(docs, rows, empty, run):
    """Repeated rows, of which one keeps its chunks; 40 copies of a text; null ids, which come last."""
    got = cdc.dedup_chunks(docs, run=run).collect()
    assert collections.Counter((r.doc_id, r.n_bytes, r.n_repeated, r.kept_sha256, r.plain_repeated, r.plain_sha256) for r in got) == slow_chunk_dedup(rows, run)
    assert all(r.n_removed == r.n_bytes - len(r.kept) and hashlib.sha256(r.kept).hexdigest() == r.kept_sha256 and r.n_repeated <= r.plain_repeated and r.n_removed <= r.plain_removed for r in got)
    assert cdc.dedup_chunks(empty).count() == 0


def test_chunk_dedup_of_equal_rows_and_ids(spark):
    """Of equal rows one stays whole, with and without an id, and so it is for two texts of one id that share a passage."""
    rng = random.Random(17)
    a, b, c, shared = words(rng, 60, 10**6), words(rng, 60, 10**6), words(rng, 60, 10**6), words(rng, 80, 10**6)
    rows = [(1, a, "en", "s")] * 3 + [(None, b, "en", "s")] * 2 + [(2, c + " " + shared, "en", "s"), (2, shared + " " + c[::-1], "en", "s")]
    got = collections.defaultdict(list)
    for r in cdc.dedup_chunks(documents(spark, rows)).collect():
        got[r.doc_id].append((r.n_bytes, r.n_removed))
    assert sorted(n for _, n in got[1])[0] == 0 and sum(n == size for size, n in got[1]) == 2
    assert sorted(n for _, n in got[None])[0] == 0 and sum(n == size for size, n in got[None]) == 1
    assert sorted(n > 0 for _, n in got[2]) == [False, True]


def test_chunk_dedup_catches_passages_of_over_fifty_words(spark):
    rng = random.Random(4)
    rows = []
    for i in range(40):
        passage = " ".join(f"{rng.randrange(10**5, 10**7)}"[: rng.randint(4, 7)] for _ in range(52))
        rows += [(2 * i + j, f"{words(rng, 60, 10**6)} {passage} {words(rng, 60, 10**6)}", "en", "a") for j in (0, 1)]
    rows += [(100 + i, words(rng, 150, 10**6), "en", "a") for i in range(40)]
    got = {r.doc_id: r.n_repeated for r in cdc.dedup_chunks(documents(spark, rows)).collect()}
    assert all(got[i] > 0 for i in range(80)) and not any(got[100 + i] for i in range(40))


# --- 3 nearest neighbours


def vectors(spark, data):
    return spark.createDataFrame([(i, v, "x", 1) for i, v in data], "vec_id long, embedding array<float>, v string, b int").repartition(4)


def test_forest_recall_and_ties(spark):
    rng = np.random.default_rng(5)
    x = rng.standard_normal((3000, 24)).astype(np.float32) * rng.uniform(0.5, 2, (3000, 1)).astype(np.float32)
    x[100:160] = x[100]  # a class of copies
    got = collections.defaultdict(list)
    for r in prefix_forest.nearest(vectors(spark, [(i, v.tolist()) for i, v in enumerate(x)]), block=700).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
    d, hits = x.astype(np.float64), 0
    assert sorted(got) == list(range(0, 3000, 20))
    for q, found in got.items():
        score = d @ d[q]
        score[q] = -np.inf
        hits += len({v for v, _ in found} & set(np.lexsort((np.arange(3000), -score))[:20].tolist()))
        assert len(found) == 20 and all(abs(s - d[v] @ d[q]) < 1e-12 for v, s in found) and found == sorted(found, key=lambda f: (-f[1], f[0]))
    assert hits / (20 * len(got)) >= 0.9
    assert [v for v, _ in got[100]][:5] == [v for v in range(100, 160) if v != 100][:5] or d[100] @ d[100] < max(s for _, s in got[100])


def test_forest_leaves_out_what_is_no_vector(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (20, None), (40, [0.0, -0.0]), (60, [1.0, nan]), (80, [inf, 1.0]), (1, [None, 1.0]), (2, [1.0]), (3, []), (4, [0.5, 0.5]), (5, [0.5, 0.5]), (None, [1.0, 1.0]), (4, [0.5, 0.5])]
    got = [(r.query_id, r["rank"], r.vec_id, r.score) for r in prefix_forest.nearest(vectors(spark, rows)).orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 4, 0.5), (0, 2, 5, 0.5)]
    assert prefix_forest.nearest(vectors(spark, rows[1:4])).count() == 0 and prefix_forest.nearest(vectors(spark, rows).where("false")).count() == 0


def exact_neighbours(x, ids, queries, k=20):
    score = x[queries] @ x.T
    score[np.arange(len(queries)), queries] = -np.inf
    return [set(ids[np.lexsort((ids, -row))[:k]].tolist()) for row in score]


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_forest_recall_on_the_tables(spark, sf):
    """The registered query against brute force."""
    from quarrymill.llm import queries

    folder = f"/root/testdata/{sf}"
    table = spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "embedding").toPandas()
    x, ids = np.stack(table["embedding"].to_list()).astype(np.float64), table["vec_id"].to_numpy()
    asked = np.flatnonzero(ids % 20 == 0)
    want = dict(zip(ids[asked].tolist(), exact_neighbours(x, ids, asked), strict=True))
    got = collections.defaultdict(set)
    for r in queries.op3_prefix_forest(spark, folder).collect():
        got[r.query_id].add(r.vec_id)
    assert set(got) == set(want) and all(len(v) == 20 for v in got.values())
    assert sum(len(got[q] & want[q]) for q in want) >= 0.9 * 20 * len(want)


def test_forest_scores_little_where_neighbours_are_near():
    """In clusters, as real embeddings are, the ascent ends after a small share; recall by brute force."""
    rng = np.random.default_rng(16)
    centres = rng.standard_normal((200, 32))
    x = centres[rng.integers(0, 200, 6000)] + 0.35 * rng.standard_normal((6000, 32))
    queries = np.arange(0, 6000, 60)
    found, scored = prefix_forest.search_block(x, [[i] for i in range(6000)], x[queries], queries, 20, float((x**2).sum(axis=1).max()))
    got = collections.defaultdict(set)
    for q, v, _ in found:
        got[q].add(v)
    want = exact_neighbours(x, np.arange(6000), queries)
    assert sum(len(got[int(q)] & w) for q, w in zip(queries, want, strict=True)) >= 0.9 * 20 * len(queries)
    assert scored < 0.4 * 6000 * len(queries)


def test_forest_batches_meet_what_single_ascents_meet(monkeypatch):
    """Each depth adds the rows that share a prefix of so many bits in any tree; copies are crowded at every depth."""
    monkeypatch.setattr(prefix_forest, "STEP", 500)
    rng = np.random.default_rng(21)
    x = rng.standard_normal((500, 9))
    x[100:300] = x[100] + 1e-9 * x[100:300]
    x /= np.sqrt((x**2).sum(axis=1))[:, None]
    top = float((x**2).sum(axis=1).max())
    forest = prefix_forest.Forest(prefix_forest.augmented(x, top), 12)
    base, asked = forest.strings(prefix_forest.augmented(x, top)), forest.strings(prefix_forest.probes_of(x[::7]))
    shared = np.array([[forest.bits - int(d).bit_length() for d in np.bitwise_xor(base, q[:, None]).ravel()] for q in asked.T])
    longest = shared.reshape(len(x[::7]), 12, len(x)).max(axis=1)
    seen, depths = [set() for _ in longest], collections.defaultdict(list)

    def take(depth, q, rows):
        assert not seen[q] & set(rows.tolist()) and len(set(rows.tolist())) == len(rows)
        seen[q] |= set(rows.tolist())
        assert seen[q] == set(np.flatnonzero(longest[q] >= depth).tolist())
        depths[q].append(depth)
        return depth <= q % 9

    forest.ascend(asked, 21, take)
    for q, own in depths.items():
        assert own == list(range(own[0], q % 9 - 1, -1)) and (own[0] == forest.bits or (longest[q] > own[0]).sum() < 21)
    assert len(depths) == len(longest) and {own[0] for own in depths.values()} == {forest.bits, forest.short}


def test_forest_costs_little_beside_scores_where_neighbours_are_far():
    """Random unit vectors, of which two in five are scored: the ascents take little beside the scores themselves."""
    rng = np.random.default_rng(22)
    x = rng.standard_normal((12_800, 64))
    x /= np.sqrt((x**2).sum(axis=1))[:, None]
    queries, ids = np.arange(0, 12_800, 25), [[i] for i in range(12_800)]

    def seconds(work):
        began = time.thread_time()
        work()
        return time.thread_time() - began

    plain = min(seconds(lambda: [(x * x[q]).sum(axis=1) for q in queries]) for _ in range(3))
    forest = min(seconds(lambda: prefix_forest.search_block(x, ids, x[queries], queries, 20, 1.0, 0.36)) for _ in range(3))
    assert forest < 2.5 * plain, f"scans {plain:.2f} s, forest {forest:.2f} s"


def test_router_sends_queries_to_few_leaves():
    rng = np.random.default_rng(17)
    centres = rng.standard_normal((300, 24))
    x = centres[rng.integers(0, 300, 20_000)] + 0.25 * rng.standard_normal((20_000, 24))
    top = float((x**2).sum(axis=1).max())
    router = prefix_forest.Router(24, len(x), top, 500)
    unit = prefix_forest.augmented(x, top)
    codes = router.codes(unit)
    router.grow(dict(zip(*(c.tolist() for c in np.unique(codes, return_counts=True)), strict=True)))
    leaf = router.leaf_of(codes)
    assert len(router.leaves) > 30 and len({d for _, d, _ in router.leaves}) > 1
    assert all(np.bincount(leaf, minlength=len(router.leaves))[i] <= 500 * parts for i, (*_, parts) in enumerate(router.leaves))
    queries = np.arange(0, len(x), 200)
    router.learn(x[:2000], 20, len(x))
    visited = [set(v.tolist()) for v in router.visits(prefix_forest.probes_of(x[queries]), 0.98)]
    want = exact_neighbours(x, np.arange(len(x)), queries)
    assert sum(leaf[v] in own for own, w in zip(visited, want, strict=True) for v in w) >= 0.95 * 20 * len(queries)
    assert sum(map(len, visited)) < 0.8 * len(router.leaves) * len(queries)


def test_forest_with_leaves_of_copies_and_vector_lengths(spark):
    """Small leaves, some that no prefix cuts; two vector lengths, each searched by itself; all candidates, if fewer."""
    rng = np.random.default_rng(18)
    x = rng.standard_normal((900, 8))
    x[300:700] = x[300] * (1 + 1e-9 * np.arange(400))[:, None]  # nearly equal: no plane parts them
    y = rng.standard_normal((12, 5))
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(2000 + i, v.tolist()) for i, v in enumerate(y)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(5)
    got = collections.defaultdict(list)
    for r in prefix_forest.nearest(df, block=60).orderBy("query_id", "rank").collect():
        got[r.query_id].append(r.vec_id)
    assert set(got) == {*range(0, 900, 20), 2000} and all(len(v) == 20 for q, v in got.items() if q < 900)
    score = y @ y[0]
    assert got[2000] == [2000 + int(i) for i in np.argsort(-score) if i != 0]
    asked = np.arange(0, 900, 20)
    want = exact_neighbours(x, np.arange(900), asked)
    plain = [i for i, q in enumerate(asked.tolist()) if not 300 <= q < 700]
    assert sum(len(set(got[int(asked[i])]) & want[i]) for i in plain) >= 0.9 * 20 * len(plain)


# --- 4 simhash


def slow_fingerprint(text, width=3):
    w = re.findall(rb"[^\x20\x09-\x0d]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), raw(text)))
    if not w:
        return 0
    shingles = [b" ".join(w[i : i + width]) for i in range(len(w) - width + 1)] or [b" ".join(w)]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(values, radius):
    parent = list(range(len(values)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(values)):
        for j in range(i):
            if (values[i] ^ values[j]).bit_count() <= radius:
                parent[max(find(i), find(j))] = min(find(i), find(j))
    return [find(i) for i in range(len(values))]


@pytest.mark.parametrize("block", [simhash.BLOCK, 4])
def test_near_groups(docs, rows, block):
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0]))
    prints = [slow_fingerprint(rows[i][1]) for i in order]
    least = slow_components(prints, 2)
    want = collections.Counter((rows[i][0], f"{p:016x}", rows[order[c]][0]) for i, p, c in zip(order, prints, least, strict=True))
    assert collections.Counter(tuple(r) for r in simhash.near_groups(docs, block=block).collect()) == want


def test_grid_grows_with_the_table(docs):
    chosen = [simhash.grid(n, 2) for n in (1, 10**5, 10**8, 10**11)]
    assert chosen == sorted(chosen) and chosen[0] == 4 and chosen[-1] > 7
    want = sorted(map(tuple, simhash.near_groups(docs).collect()), key=repr)
    assert all(sorted(map(tuple, simhash.near_groups(docs, groups=g).collect()), key=repr) == want for g in (6, 10))


def test_simhash_hash_is_sparks(spark):
    assert spark.sql("SELECT xxhash64('one two three')").first()[0] == int(np.array([xxhash.xxh64_intdigest(b"one two three", 42)], np.uint64).view(np.int64)[0])


@settings(max_examples=30, deadline=None)
@given(st.lists(st.integers(0, 2**64 - 1), min_size=1, max_size=12), st.randoms(), st.integers(0, 3))
def test_links_keep_all_components(seeds, rng, radius):
    values = list(dict.fromkeys(v ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for v in seeds for _ in range(8)))
    fps = np.array(values, np.uint64).view(np.int64)
    edges = simhash.forest(fps, radius)
    assert len(edges) < len(fps)
    parent = list(range(len(fps)))
    for a, b in edges.tolist():
        old, new = parent[a], parent[b]
        parent = [new if p == old else p for p in parent]
    want = slow_components(values, radius)
    assert len(set(parent)) == len(set(want)) and len(set(zip(parent, want, strict=True))) == len(set(want))
    for groups in (4, 5, 7, 12) if radius == 2 else ():  # every link shares a cell, however fine
        cells = simhash.cells(fps, groups, groups - 2)
        for i in range(len(values)):
            for j in range(i):
                if (values[i] ^ values[j]).bit_count() <= 2:
                    assert (cells[i] == cells[j]).any()


def slow_keep(rows):
    """The rows that stay: groups of equal or close fingerprints, or of similar ones whose texts are."""
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    prints, sets = [slow_fingerprint(r[1]) for r in rows], [simhash.shingles(raw(r[1]), 5) for r in rows]
    for i in range(len(rows)):
        for j in range(i):
            d = (prints[i] ^ prints[j]).bit_count()
            if d <= 2 or d <= 12 and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                parent[max(find(i), find(j))] = min(find(i), find(j))
    groups = collections.defaultdict(list)
    for i, r in enumerate(rows):
        groups[find(i)].append((r[0] is None, r[0] or 0))
    return collections.Counter(None if last else i for last, i in map(min, groups.values()))


def test_keep_one_and_empty(docs, rows, empty):
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns and collections.Counter(r.doc_id for r in kept.collect()) == slow_keep(rows)
    assert simhash.keep_one(empty).count() == 0 and simhash.near_groups(empty).count() == 0


def test_keep_one_finds_near_copies_and_leaves_others(spark):
    rng = random.Random(11)
    rows, clean = [], []
    for i in range(150):
        text = words(rng, rng.randint(60, 400), 5000).split()
        rows.append((i, " ".join(text), "en", "a"))
        for k in range(2):
            changed = list(text)
            for _ in range(max(1, len(text) // 60)):  # shingles stay at 0.8 or so
                changed[rng.randrange(len(changed))] = f"new{rng.randrange(10**6)}"
            rows.append((1000 + 2 * i + k, " ".join(changed), "en", "a"))
        clean.append((5000 + i, words(rng, rng.randint(60, 400), 5000), "en", "a"))
    kept = {r.doc_id for r in simhash.keep_one(documents(spark, rows + clean)).collect()}
    assert {r[0] for r in clean} <= kept and {r[0] for r in rows[::3]} <= kept
    sets = {r[0]: simhash.shingles(raw(r[1]), 5) for r in rows}
    alike = [c for i in range(150) for c in (1000 + 2 * i, 1001 + 2 * i) if len(sets[i] & sets[c]) >= 0.8 * len(sets[i] | sets[c])]
    assert len(alike) > 150 and len(set(alike) & kept) <= 0.1 * len(alike)


def slow_keep_similar(rows):
    """slow_keep without a limit on the fingerprints of similar texts."""
    prints, sets = [slow_fingerprint(r[1]) for r in rows], [simhash.shingles(raw(r[1]), 5) for r in rows]
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if group[i] != group[j] and ((prints[i] ^ prints[j]).bit_count() <= 2 or len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])):
                group = [group[j] if g == group[i] else g for g in group]
    return collections.Counter(min(r[0] for r, g in zip(rows, group, strict=True) if g == label) for label in set(group))


def test_keep_one_finds_every_similar_pair(spark):
    """Single pairs at just over 0.8: about one in eight lay beyond the fingerprints' grid."""
    rng, rows = random.Random(5), []
    for size, changes in [(40, 1), (100, 2), (300, 6), (1000, 20)]:
        for _ in range(30):
            text = [f"{rng.randrange(10**6)}" for _ in range(size)]
            other = list(text)
            for at in rng.sample(range(size // 10), changes) if changes > 1 else [0]:
                other[at * 10 + (4 if changes > 1 else 3)] = f"new{rng.randrange(10**6)}"
            rows += [(len(rows), " ".join(text), "en", "a"), (len(rows) + 1, " ".join(other), "en", "a")]
    want = slow_keep_similar(rows)
    sets = [simhash.shingles(raw(r[1]), 5) for r in rows]
    assert sum(len(x & y) >= 0.8 * len(x | y) for x, y in zip(sets[::2], sets[1::2], strict=True)) == 120 == len(want)
    assert collections.Counter(r.doc_id for r in simhash.keep_one(documents(spark, rows)).collect()) == want


def test_keep_one_of_a_crowded_family(spark, monkeypatch):
    """One base and 200 variants: many are nearer in bits to another variant than to the one they are similar to."""
    monkeypatch.setattr(simhash, "SMALL", 1)
    rng = random.Random(8)
    base, rows = [f"{rng.randrange(10**6)}" for _ in range(120)], []
    for i in range(201):
        text = list(base)
        for at in rng.sample(range(12), min(i, 1 + i % 4)):
            text[at * 10 + 4] = f"new{rng.randrange(10**6)}"
        rows.append((i, " ".join(text), "en", "a"))
    assert collections.Counter(r.doc_id for r in simhash.keep_one(documents(spark, rows)).collect()) == slow_keep_similar(rows)


def test_keep_one_compares_every_text_of_a_fingerprint(spark):
    """A repeated passage gives different texts one fingerprint; each of them has a similar text without the repeats."""
    rng = random.Random(3)
    passage, rows = [f"{rng.randrange(10**6)}" for _ in range(11)], []
    for _ in range(4):
        own = [f"{rng.randrange(10**6)}" for _ in range(60)]
        rows += [(len(rows), " ".join(passage * 60 + own), "en", "a"), (len(rows) + 1, " ".join(passage + own), "en", "a")]
    assert len({slow_fingerprint(r[1]) for r in rows[::2]}) == 1
    assert collections.Counter(r.doc_id for r in simhash.keep_one(documents(spark, rows)).collect()) == slow_keep_similar(rows) == {0: 1}


def test_components_of_long_chains(spark):
    edges = [(i, i + 1) for i in range(60)] + [(1000, 900), (900, 950)] + [(5, 5)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(61)}, 900: 900, 950: 900, 1000: 900}


# --- 5 packing


def check_pieces(pieces, want, window=1024):
    """want: Counter of (doc_id, ids as tuple)."""
    cover, sequences = collections.defaultdict(list), collections.defaultdict(list)
    for p in pieces:
        cover[(p.doc_id, p.doc_tokens)].append((p.start, p.length, p.ids_crc32))
        sequences[p.sequence_id].append((p.offset, p.length))
    total = 0
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at <= window and at & (at - 1) == 0
        total += at
    by_size = collections.Counter()
    for (doc_id, ids), n in want.items():
        by_size[(doc_id, len(ids))] += n
    assert total == sum(n * k[1] for k, n in by_size.items()) == sum(x[1] for parts in cover.values() for x in parts)
    assert set(by_size) == set(cover)
    for (doc_id, ids), n in want.items():
        if by_size[(doc_id, len(ids))] == 1:
            at = 0
            for start, length, crc in sorted(cover[(doc_id, len(ids))]):
                assert start == at and zlib.crc32(np.array(ids[start : start + length], "<u4").tobytes()) == crc
                at += length
            assert at == len(ids) and n == 1


def test_packing(docs, rows, empty):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(packing.tokenizer_paths()[0])
    want = collections.Counter((r[0], (*t.encode(r[1] or "", add_special_tokens=False).ids, 0)) for r in rows)
    check_pieces(packing.pack(docs).collect(), want)
    check_pieces(packing.pack(docs, buffer=5).collect(), want)
    assert packing.pack(empty).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.text(max_size=200))
def test_encoder_is_the_tokenizers_one(text):
    e = packing.encoder(packing.tokenizer_paths())
    assert e.ids(text).tolist() == e.exact(text).tolist()


@pytest.mark.parametrize("ch", [" ", "\n", "\t", "\u00a0", "x", "7", "!", "é", "漢", "😀", "\0", " a", "'s"])
def test_encoder_takes_a_megabyte_of_anything(ch):
    e = packing.encoder(packing.tokenizer_paths())
    text = "first words " + ch * (1_000_000 // len(ch)) + " last words"
    assert np.array_equal(e.ids(text), e.exact(text))


def test_long_white_space_goes_through(spark):
    from tokenizers import Tokenizer

    rows = [(1, "a" + " " * 1_000_000 + "b", "en", "a"), (2, "\n" * 1_000_000, "en", "a"), (3, "c", "en", "a")]
    t = Tokenizer.from_file(packing.tokenizer_paths()[0])
    check_pieces(packing.pack(documents(spark, rows)).collect(), collections.Counter((r[0], (*t.encode(r[1], add_special_tokens=False).ids, 0)) for r in rows))


def test_tiers_hold_documents_whole_and_steps_are_even(spark):
    rng = random.Random(12)
    rows = [(i, words(rng, rng.choice([5, 20, 40, 80, 160, 300])), "en", "a") for i in range(4000)]
    got = packing.pack(documents(spark, rows).coalesce(1), buffer=800).collect()
    sizes = collections.Counter(p.sequence_tokens for p in got if p.offset == 0)
    assert sizes[1024] > 0 and sizes[512] > 0 and sizes[256] + sizes[128] > 0 and sum(n for k, n in sizes.items() if k < 128) <= 7
    whole = [p for p in got if p.length == p.doc_tokens]
    assert len(whole) > 0.75 * len(rows)  # one cut at most for each window
    for p in whole:  # routed to a tier that holds it, or filling the gap of a longer one
        assert p.sequence_tokens >= p.doc_tokens
    steps = collections.defaultdict(collections.Counter)
    for p in got:
        steps[p.sequence_tokens][p.step_group] += p.length
    assert all(n <= 8 * 1024 for k in (128, 256, 512, 1024) for n in steps[k].values())
    assert all(max(steps[k].values()) - min(steps[k].values()) <= 8 * 1024 for k in steps)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 5000), max_size=60), st.integers(1, 40))
def test_packer_fills_everything(lengths, buffer):
    packer = packing.Packer(packing.TIERS, buffer)
    for n, length in enumerate(lengths):
        packer.add((n, length), np.arange(length, dtype="<u4"))
    packer.finish()
    sizes = [sum(len(p[2]) for p in s) for s in packer.done]
    assert sum(sizes) == sum(lengths) and all(s & (s - 1) == 0 and s <= 1024 for s in sizes) and sum(s < 128 for s in sizes) <= 10
    seen = collections.defaultdict(list)
    for s in packer.done:
        for doc, start, ids in s:
            assert ids[0] == start
            seen[doc[0]] += ids.tolist()
    assert all(sorted(seen[n]) == list(range(length)) for n, length in enumerate(lengths))


# --- 6 personal data

PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits):
    total = 0
    for i, ch in enumerate(reversed(digits)):
        v = int(ch) * (1 + i % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def base_spans(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            good = {"email": True, "ip": kind != "ip" or all(int(p) <= 255 for p in m[0].split(".")), "card": 16 <= len(digits) <= 19 and luhn(digits), "phone": 8 <= len(digits) <= 15}[kind]
            if good:
                out.append((kind, m.start(), m.end()))
    return out


NASTY = [
    None, "", "a@b.c_d@e.f g@h", "x.y%z+1@sub-d.example.com.", "@a.b", "a@b", "é漢😀a@b.co and 😀 b@c.de", "1.2.3.4.5.6.7.8", "256.1.1.1 1.1.1.256 000255.0.0.1", "1.2.3", "99999999999999999999.1.1.1 12.34.56.78",
    "4532015112830366 4532-0151-1283-0366 4532 0151 1283 0366", "5 4532015112830366", "45320151128303661", "4532  0151", "4532015112830366-", "0000000000000000000", "00000000000000000000", "+1 (743) 555-3824", "+1234567", "+12345678", "++1 2345678 9", "+123456789012345678", "+1......2....3", "+4 4",
    "1" * 5000, "1-" * 3000, "a" * 5000 + "@", "a@" * 2000, "a@b.c" * 900, "+1" * 2000, "1." * 4000, "+1 " + "(" * 3000, "call (555) 123-4567 now", "john dot smith at mail dot com", "id 00:1a:2b:3c:4d:5e end", "DE44 5001 0517 5407 3249 31", "2026-01-01 10:11:12", "token = \"24be64439e3e49cf46b2d7c90f3602a3d0b907ff\"",
]


def test_base_spans(spark, rows, empty):
    texts = NASTY + [r[1] for r in rows]
    got = {r.doc_id: r for r in pii.find(documents(spark, [(i, t, None, None) for i, t in enumerate(texts)])).collect()}
    for i, text in enumerate(texts):
        base = base_spans(text or "")
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        r = got[i]
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest(), text and text[:80]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(b[0] == k for b in base) for k in PATTERNS]
        assert set(joined.split(",")) - {""} <= set(r.spans.split(","))
    assert pii.find(empty).count() == 0
    assert [got[NASTY.index(t)].spans.split(":")[0] for t in NASTY[-6:-2]] == ["phone", "email", "ip", "account"] and got[len(NASTY) - 1].spans == "" == got[len(NASTY) - 2].spans


@settings(max_examples=150, deadline=None)
@given(st.text("a1+@.-_ ()é😀59", max_size=60))
def test_patterns_never_backtrack_but_match_alike(text):
    import regex

    for kind, pattern in pii.BASE.items():
        found = [(m.start(), m.end()) for m in regex.finditer(pattern, text)]
        want = [(m.start(), m.end()) for m in re.finditer(PATTERNS[kind], text) if kind != "card" or 16 <= len(re.sub("[^0-9]", "", m[0])) <= 19]
        assert found == want


def test_features_are_the_same_in_sql(spark):
    cases = [(1, "(555) 123-4567", "call me: ", " "), (0, "a at b dot com", "x ", "."), (3, "DE44 5001 0517 5407 3249 31", "IBAN ", ""), (2, "00:1A:2b:3c:4d:5e", "id=", '"'), (1, "4532015112830366"[:15], "", "")]
    for generator, value, before, after in cases:
        df = spark.createDataFrame([(value, before, after)], "value string, before string, after string").selectExpr("struct(*) AS c")
        got = df.selectExpr(*(f"double({x}) AS f{i}" for i, x in enumerate(pii.features_sql(generator)))).first()
        assert list(got) == pii.features_of(generator, value, before, after)


def test_trees_in_sql_and_held_out_precision(spark):
    trees, thresholds = pii.model()
    x, y = pii.examples()
    sql = boosting.as_sql(trees, [f"f[{i}]" for i in range(len(pii.FEATURES))])
    got = [r[0] for r in spark.createDataFrame([(row.tolist(),) for row in x[:200]], "f array<double>").selectExpr(sql).collect()]
    assert np.allclose(got, boosting.score(trees, x[:200]), atol=1e-5)
    fresh, truth = pii.examples(4000, seed=99)
    chosen = boosting.score(trees, fresh) >= np.array(thresholds)[fresh[:, 0].astype(int)]
    assert truth[chosen].mean() > 0.98 and truth[chosen].sum() > 0.8 * truth.sum()


def test_redaction(spark):
    rows = [(1, "mail a@b.co or +1 (743) 555-3824!", "en", "s"), (2, None, "en", "s"), (3, "clean", "en", "s"), (4, "x 4532015112830366", None, None)]
    df = documents(spark, rows)
    got = {r.doc_id: r for r in pii.redact(df).collect()}
    assert got[1].text == "mail [EMAIL] or [PHONE]!" and got[1].n_chars == len(got[1].text) and got[2].text is None and got[3].text == "clean" and got[4].text == "x [CARD]" and got[1]._text == "t"
    assert pii.redact(df).columns == df.columns and pii.redact(df).schema == df.schema


def test_dense_texts(spark):
    """100,000 matches in one text, some of them spelt out and some in two kinds; redaction by the reported spans."""
    rng = random.Random(22)
    forms = [lambda i: f"user{i}@mail{i % 97}.example.com", lambda i: f"user{i} at mail dot com", lambda i: f"call ({i % 900 + 100:03d}) 555-{i % 10000:04d}", lambda i: f"+1 {i % 900 + 100} 555 {i % 10000:04d}", lambda i: f"漢 10.0.{i % 256}.{i % 300}"]
    small = ", ".join(rng.choice(forms)(i) for i in range(3000)) + " 12@34.56.78.90 +1 555 123 4567@x.yz"
    large = " ".join(forms[0](i) for i in range(100_000))
    df = documents(spark, [(1, small, None, None), (2, large, None, None)])
    got = {r.doc_id: r for r in pii.find(df).collect()}
    for i, text in ((1, small), (2, large)):
        base = base_spans(text)
        assert got[i].base_sha256 == hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in base).encode()).hexdigest()
    spans = sorted((int(a), int(b), [*pii.KINDS, "account"].index(k)) for k, a, b in (x.split(":") for x in got[1].spans.split(",")))
    added = set(got[1].spans.split(",")) - {f"{k}:{a}:{b}" for k, a, b in base_spans(small)}
    assert len(added) > 800
    out, at = [], 0
    for a, b, kind in spans:
        if a >= at:
            out += [small[at:a], f"[{[*pii.KINDS, 'account'][kind].upper()}]"]
        at = max(at, b)
    redacted = {r.doc_id: r.text for r in pii.redact(df).collect()}
    assert redacted[1] == "".join(out) + small[at:] and redacted[2] == " ".join(["[EMAIL]"] * 100_000)


# --- 7 sharding


def test_sharding(docs, rows, empty):
    got = sharding.shard_documents(docs, 4).collect()
    want = collections.Counter((r[0], len(raw(r[1])) + 8, zlib.crc32(raw(r[1]))) for r in rows)
    assert collections.Counter((r.doc_id, r["size"], r.text_crc32) for r in got) == want and {r.law for r in got} == {"bytes"}
    for shard in range(4):
        own = sorted(r.slot for r in got if r.shard == shard)
        assert own == list(range(len(own)))
    assert sharding.shard_documents(empty).count() == 0


def test_shards_are_even_and_groups_stay_together(spark):
    rng = random.Random(7)
    rows = [(i, words(rng, rng.randint(1, 200)), None, None) for i in range(3000)] + [(5000 + i, "hot " * 50, None, None) for i in range(1500)] + [(9000 + i, words(random.Random(i % 100), 30), None, None) for i in range(500)]
    got = sharding.shard_documents(documents(spark, rows), 12).collect()
    sizes = collections.Counter()
    for r in got:
        sizes[r.shard] += r["size"]
    assert max(sizes.values()) - min(sizes.values()) < 0.005 * sum(sizes.values()) / 12
    places, texts = collections.defaultdict(set), dict((r[0], r[1]) for r in rows)
    for r in got:
        places[texts[r.doc_id]].add(r.shard)
    assert [len(p) for t, p in places.items() if len(p) > 1] == [len(places["hot " * 50])]


@pytest.mark.parametrize("lot", [sharding.LOT, 300])
def test_groups_below_a_shard_are_never_cut(spark, monkeypatch, lot):
    """Groups of up to 0.8 of a shard in rows, some of them the largest in bytes; lots small enough to have several."""
    monkeypatch.setattr(sharding, "LOT", lot)
    monkeypatch.setattr(sharding, "HEAVY", 8)
    rng = random.Random(9)
    texts = [(words(rng, rng.randint(1, 60), 10**4), rng.choice([1, 1, 1, 2, 5])) for _ in range(2400)]
    texts += [(words(rng, 30), 150), (words(rng, 3), 260), (words(rng, 900), 6), (None, 200), ("", 120)]
    rows = [(i, t, None, None) for i, t in enumerate(t for t, n in texts for _ in range(n))]
    got = sharding.shard_documents(documents(spark, rows), 20).collect()
    places, sizes, counts = collections.defaultdict(set), collections.Counter(), collections.Counter()
    for r in got:
        places[rows[r.doc_id][1]].add(r.shard)
        sizes[r.shard] += r["size"]
        counts[r.shard] += 1
    assert len(got) == len(rows) and max(map(len, places.values())) == 1 and 260 < len(rows) / 20
    assert max(sizes.values()) - min(sizes.values()) < 0.01 * sum(sizes.values()) / 20
    for shard in range(20):
        assert sorted(r.slot for r in got if r.shard == shard) == list(range(counts[shard]))


# --- 8 language


def test_language(spark, docs, rows, empty):
    rng = random.Random(8)
    alphabets = {"xx": "abcdefg", "yy": "éèàçu", "zz": "mnopqrs"}
    text = lambda lang, n: " ".join("".join(rng.choice(alphabets[lang]) for _ in range(rng.randint(2, 7))) for _ in range(n))
    data = [(i, text(lang := rng.choice(list(alphabets)), rng.randint(5, 80)), lang, "s") for i in range(300)]
    got = {r.doc_id: r for r in langid.identify(documents(spark, data)).collect()}
    assert all(got[i].held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i, *_ in data)
    held = [(got[i].lang_pred, lang) for i, _, lang, _ in data if got[i].held_out]
    assert len(held) > 30 and all(a == b for a, b in held) and all(0 <= r.score <= 1 for r in got.values())
    odd = langid.identify(docs).collect()
    assert len(odd) == len(rows) and all(r.lang_pred == "und" and r.score == 0 for r in odd if r.doc_id in (1, 2, 3, 14, 15))
    assert langid.identify(empty).count() == 0 and {r.lang_pred for r in langid.identify(docs.drop("lang").withColumn("lang", docs.text.substr(0, 0))).where("doc_id = 7").collect()} <= {"", "und"}
    kept = langid.keep_known(docs)
    assert kept.schema == docs.schema and {r.doc_id for r in kept.collect()} <= {r[0] for r in rows if r[1] and any(ch.isalpha() for ch in r[1])}
    assert langid.keep_known(empty).count() == 0


def test_language_stage_rejects_other_languages_and_random_letters(spark):
    """Held-out documents of the languages learnt stay, what is in none of them goes; the label is never looked at."""
    rng = random.Random(21)
    syllables = {"xx": ["ka", "lo", "mi", "ter", "un"], "yy": ["été", "où", "ça", "ple"], "ру": ["на", "ко", "сто", "го", "ты"]}
    text = lambda parts, n: " ".join("".join(rng.choice(parts) for _ in range(rng.randint(1, 4))) for _ in range(n))
    known = [(i, text(syllables[lang := rng.choice(list(syllables))], rng.randint(1, 200)), lang, "s") for i in range(400)]
    noise = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(600)) for _ in range(12)]
    other = [text(["ωρα", "λογ", "μεν"], 80) for _ in range(12)] + [text(["漢字", "日本", "語学"], 80) for _ in range(12)]
    odd = [(1000 + n, t, None, "s") for n, t in enumerate([*noise, *other, "", " 12 !", None])]
    rows = known + odd
    kept = {r.doc_id for r in langid.keep_known(documents(spark, rows)).collect()}
    assert kept == {r[0] for r in known}
    found = {r.doc_id: r for r in langid.identify(documents(spark, rows)).collect()}
    assert all(found[i].lang_pred == lang for i, _, lang, _ in known)


def test_language_of_held_out_documents(spark, sf_dir):
    found = langid.identify(spark.read.parquet(f"{sf_dir}/documents.parquet")).join(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang", "text"), "doc_id").collect()
    held = [r for r in found if r.held_out and r.lang and r.lang_pred != "und"]
    assert len(held) > 20 and sum(r.lang == r.lang_pred for r in held) >= 0.98 * len(held)


def slow_ngrams(text):
    """n-grams of the text with its non-letters as single blanks, those of blanks alone left out."""
    import unicodedata

    plain = re.sub(" +", " ", " " + "".join(ch.lower()[0] if unicodedata.category(ch)[0] == "L" else " " for ch in text) + " ")
    grams = [plain[i : i + n] for n in (1, 2, 3) for i in range(len(plain) - n + 1)]
    return collections.Counter(g for g in grams if (g[1] != " " if len(g) == 3 else g.strip()))


def code(gram):
    out = 0
    for ch in gram:
        out = out << 21 | (1 if ch == " " else ord(ch))
    return out


@settings(max_examples=80, deadline=None)
@given(st.text("abé ωЖ漢ßİ1.\t", max_size=40))
def test_ngrams_are_those_of_the_whole_text(text):
    assert collections.Counter(langid.ngram_codes(text.encode()).tolist()) == collections.Counter({code(g): n for g, n in slow_ngrams(text).items()})


@settings(max_examples=40, deadline=None)
@given(st.lists(st.text("abcde ж", min_size=1, max_size=60), min_size=1, max_size=4), st.text("abcde ж", max_size=60), st.integers(2, 12))
def test_language_distance_is_the_out_of_place_one(texts, text, size):
    top = lambda t: [code(g) for g, _ in sorted(slow_ngrams(t).items(), key=lambda x: (-x[1], code(x[0])))][:size]
    profiles = {f"l{i}": top(t) for i, t in enumerate(texts)}
    own = top(text)
    want = [sum(abs(own.index(c) - p.index(c)) if c in p else size for c in own) for p in profiles.values()]
    distance, many = langid.Scorer({k: np.array(p, np.int64) for k, p in profiles.items()}, size).distances(text.encode())
    assert many == len(own) and distance.tolist() == want


# --- 9 mixing


def water_fill(sizes):
    """sizes: source (None last) to words; targets by repeated resharing."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [None] * (None in sizes)
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    total, capped = 1.5 * sum(sizes.values()), set()
    while True:
        rest, left = total - sum(2 * sizes[s] for s in capped), sum(w for s, w in weight.items() if s not in capped)
        new = {s for s in names if s not in capped and rest * weight[s] / left > 2 * sizes[s]}
        if not new:
            return {s: 2.0 * sizes[s] if s in capped else rest * weight[s] / left for s in names}
        capped |= new


def test_mixing(docs, rows, empty):
    out = mixing.mix_report(docs)
    got = out.collect()
    assert sorted(map(repr, got)) == sorted(map(repr, mixing.mix_report(docs.repartition(5)).collect()))  # reruns agree
    sizes = collections.Counter()
    for _, text, _, source in rows:
        sizes[source] += len(WORD.findall(text or ""))
    targets = water_fill(sizes)
    source_of = {r[0]: r[3] for r in rows if r[0] is not None}
    taken = collections.Counter()
    for r in got:
        assert 0 <= r.taken <= 2 * r["size"]
        if r.doc_id is not None:
            assert r.source_size == sizes[source_of[r.doc_id]] and abs(r.target - targets[source_of[r.doc_id]]) < 1e-6
        taken[(r.source_size, round(r.target, 6))] += r.taken
    for s in sizes:
        same = [t for t in sizes if (sizes[t], round(targets[t], 6)) == (sizes[s], round(targets[s], 6))]
        assert abs(taken[(sizes[s], round(targets[s], 6))] - sum(targets[t] for t in same)) <= len(same)
    assert mixing.mix_report(empty).count() == 0 and all(len(r.shards.split(",")) == -(-r.taken // r["size"]) and sum(map(int, r.words.split(","))) == r.taken for r in got if r.taken)


def test_mixed_rows_hold_the_words_taken(docs):
    want = sum(r.taken for r in mixing.mix_report(docs).collect())
    out = mixing.mixed(docs)
    got = out.collect()
    assert out.columns == docs.columns and sum(len(WORD.findall(r.text)) for r in got) == want and all(r.n_chars == len(r.text) and r._size == 9 for r in got)


def test_mixed_rows_come_shard_by_shard_and_shuffled(spark, tmp_path):
    rng = random.Random(14)
    rows = [(i, words(rng, rng.randint(1, 30)), "en", "hot" if i % 3 else f"s{i % 7}") for i in range(3000)]
    docs = documents(spark, rows)
    report = {r.doc_id: r for r in mixing.mix_report(docs).collect()}
    mixing.mixed(docs, places=True).write.parquet(str(tmp_path / "mix"))
    read = spark.read.parquet(str(tmp_path / "mix"))
    files = collections.defaultdict(list)
    for r in read.selectExpr("*", "input_file_name() AS file").collect():
        files[r.file].append((r.mix_shard, r.mix_order, r.doc_id, len(WORD.findall(r.text))))
    draws = collections.Counter()
    for own in files.values():
        assert own == sorted(own)  # each shard's part is in the order of its hashes
        draws.update((i, str(shard), str(n), str(order)) for shard, order, i, n in own)
    want = collections.Counter((i, *d) for i, r in report.items() if r.taken for d in zip(r.shards.split(","), r.words.split(","), r.places.split(","), strict=True))
    assert draws == want and {d[1] for d in draws} == {str(n) for n in range(16)}
    # neighbours in a shard are neither of one block nor in the order of ids
    longest = max(files.values(), key=len)
    assert sum(a[2] < b[2] for a, b in zip(longest, longest[1:])) < 0.6 * len(longest)


def test_mixing_blocks_grow_with_the_table(spark, monkeypatch):
    """Small blocks and shards, so that there are more of both; targets are met to the word all the same."""
    rng = random.Random(15)
    rows = [(i, words(rng, rng.randint(0, 12)), "en", rng.choice(["a", "a", "a", "b", None])) for i in range(4000)]
    monkeypatch.setattr(mixing, "BLOCK_ROWS", 10)
    monkeypatch.setattr(mixing, "SHARD_WORDS", 500)
    got = mixing.mix_report(documents(spark, rows)).collect()
    assert len(got) == len(rows) and len({s for r in got for s in r.shards.split(",")} - {""}) > 32
    sizes, taken = collections.Counter(), collections.Counter()
    for r in got:
        source = rows[r.doc_id][3]
        sizes[source] += r["size"]
        taken[source] += r.taken
        assert r.taken <= 2 * r["size"]
    assert all(abs(taken[k] - t) <= 1 for k, t in water_fill(sizes).items())


@pytest.mark.parametrize("seed", range(4))
def test_targets(spark, seed):
    rng = random.Random(seed)
    sizes = {f"s{i}": rng.choice([0, 1, 5, 100, 10**rng.randint(1, 6)]) for i in range(rng.randint(1, 12))} | ({None: 50} if seed % 2 else {})
    df = spark.createDataFrame([(k is not None, k or "", v) for k, v in sizes.items()], "_known boolean, _name string, source_size long")
    got = {(r._name if r._known else None): r.target for r in mixing.targets(df).collect()}
    want = water_fill(sizes)
    assert set(got) == set(want) and all(abs(got[k] - want[k]) < 1e-6 * max(1, want[k]) for k in want)


def test_splitting_tree_keeps_quotas(docs):
    plan = mixing.block_plan(mixing.dealt(docs.select("doc_id", "text", "source"), 128).select("_known", "_name", "_block", "_size")).cache()
    draws = mixing.shard_draws(plan).collect()
    laps = collections.Counter()
    for r in plan.collect():
        laps[(r.nth, r._block)] = r.passes + bool(r.whole or r.border is not None)
    assert collections.Counter((r.nth, r._block) for r in draws) == +laps and len({(r.nth, r._block, r.lap) for r in draws}) == len(draws)
    per = collections.Counter(r.shard for r in draws)
    assert max(per.values()) - min(per[s] for s in range(16)) <= 4


def test_mixing_plan_has_no_python(docs):
    for out in (mixing.mix_report(docs), mixing.mixed(docs), pii.find(docs), pii.redact(docs)):
        assert not re.search("Python|Pandas|Arrow", out._jdf.queryExecution().executedPlan().toString())


# --- 10 suffix order


def removed(texts, length):
    count = collections.Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        mask = [False] * len(t)
        for i in range(len(t) - length + 1):
            if count[t[i : i + length]] > 1:
                mask[i : i + length] = [True] * length
        out.append(mask)
    return out


@pytest.mark.parametrize("hot", [suffix_dedup.HOT, 1])
def test_suffix_dedup(docs, rows, hot):
    texts = [raw(r[1]) for r in rows]
    want = collections.Counter()
    for (doc_id, *_), t, mask in zip(rows, texts, removed(texts, 200), strict=True):
        kept = bytes(b for b, m in zip(t, mask, strict=True) if not m)
        want[(doc_id, len(t), sum(mask), sum(m and not p for m, p in zip(mask, [False, *mask], strict=False)), hashlib.sha256(kept).hexdigest())] += 1
    got = suffix_dedup.dedup_substrings(docs, hot=hot)
    assert collections.Counter(tuple(r) for r in got.collect()) == want


def test_suffix_dedup_of_nothing(empty):
    assert suffix_dedup.dedup_substrings(empty).count() == 0


@settings(max_examples=150, deadline=None)
@given(st.lists(st.binary(max_size=25).map(lambda b: bytes(x % 3 for x in b)), min_size=1, max_size=7), st.integers(1, 6))
def test_transform(texts, length):
    symbol, common, text, start = suffix_dedup.transform(texts)
    ranked = sorted([*(b + 1000 for b in t[p:]), i] + [0, i, p] for i, t in enumerate(texts) for p in range(len(t) + 1))
    assert [(r[-2], r[-1]) for r in ranked] == list(zip(text.tolist(), start.tolist(), strict=True))
    for k, (i, p) in enumerate(zip(text.tolist(), start.tolist(), strict=True)):
        assert symbol[k] == (texts[i][p - 1] + 1 if p else 0)
        if k:
            assert common[k] == suffix_dedup.common_length(texts[i][p:], texts[text[k - 1]][start[k - 1] :])
    count = collections.Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    assert [x.tolist() for x in suffix_dedup.repeated_starts(texts, length)] == [[i for i in range(len(t) - length + 1) if count[t[i : i + length]] > 1] for t in texts]


@settings(max_examples=40, deadline=None)
@given(st.binary(min_size=200, max_size=900), st.integers(64, 300))
def test_runs_cover_each_window_once_whatever_the_block(data, block):
    h, lo, hi, at = suffix_dedup.runs(data)
    starts = [i for a, b in zip(lo, hi, strict=True) for i in range(a, b + 1)]
    assert starts == list(range(len(data) - 199)) and ((at >= hi) & (at + suffix_dedup.GRAM <= lo + 200)).all()
    h2, lo2, hi2, at2 = suffix_dedup.runs(data, block=block)
    anchor = lambda h, lo, hi, at: {i: (x, y) for x, a, b, y in zip(h, lo, hi, at, strict=True) for i in range(a, b + 1)}
    assert anchor(h, lo, hi, at) == anchor(h2, lo2, hi2, at2)
