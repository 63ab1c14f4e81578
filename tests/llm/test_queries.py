"""The registered queries over a whole test table against brute force, by the formulas of their contracts."""

import collections
import hashlib
import os
import sys
import zlib
from pathlib import Path

import numpy as np
import pytest
import test_operators as slow
from tokenizers import Tokenizer

from quarrymill.llm import packing, queries


@pytest.fixture(scope="module")
def table(spark, sf_dir):
    return [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang", "source").collect()]


def run(spark, sf_dir, name):
    return queries.QUERIES[name](spark, sf_dir).collect()


def test_op1(spark, sf_dir, table):
    want = {}
    for doc_id, text, *_ in table:
        b = slow.raw(text)
        payload = b.ljust(max(1, -(-len(b) // 576)) * 576, b"\xff")
        stored = f"P5\n24 {len(payload) // 24}\n255\n".encode() + payload
        want[doc_id] = (len(b), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]), len(stored), hashlib.sha256(stored).hexdigest())
    got = {r.doc_id: tuple(r)[1:7] for r in run(spark, sf_dir, "op1_media")}
    assert got == want


def test_op2(spark, sf_dir, table):
    got = collections.Counter((r.doc_id, r.n_bytes, r.n_repeated, r.kept_sha256, r.plain_repeated, r.plain_sha256) for r in run(spark, sf_dir, "op2_chunk_dedup"))
    assert got == slow.slow_chunk_dedup(table, slow.cdc.RUN)


def test_op4(spark, sf_dir, table):
    rows = sorted(table)
    prints = [slow.slow_fingerprint(t) for _, t, *_ in rows]
    least = slow.slow_components(prints, 2)
    want = {rows[i][0]: (f"{p:016x}", rows[c][0]) for i, (p, c) in enumerate(zip(prints, least, strict=True))}
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in run(spark, sf_dir, "op4_simhash")} == want


def test_op5(spark, sf_dir, table):
    t = Tokenizer.from_file(packing.tokenizer_paths()[0])
    pieces = run(spark, sf_dir, "op5_packing")
    slow.check_pieces(pieces, collections.Counter((i, (*t.encode(text or "", add_special_tokens=False).ids, 0)) for i, text, *_ in table))
    assert {p.padded_to for p in pieces} <= {2**n for n in range(11)}


def test_op6(spark, sf_dir, table):
    got = {r.doc_id: r for r in run(spark, sf_dir, "op6_pii")}
    assert len(got) == len(table)
    for doc_id, text, *_ in table:
        base = slow.base_spans(text or "")
        listed = [f"{k}:{a}:{b}" for k, a, b in base]
        r = got[doc_id]
        assert r.base_sha256 == hashlib.sha256(",".join(listed).encode()).hexdigest() and set(listed) <= set(r.spans.split(","))
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(b[0] == k for b in base) for k in slow.PATTERNS)


def test_op7(spark, sf_dir, table):
    got = run(spark, sf_dir, "op7_sharding")
    texts = {i: text for i, text, *_ in table}
    assert {(r.doc_id, r["size"], r.text_crc32) for r in got} == {(i, len(slow.raw(t)) + 8, zlib.crc32(slow.raw(t))) for i, t in texts.items()}
    sizes, places, slots = collections.Counter(), collections.defaultdict(set), collections.defaultdict(list)
    for r in got:
        sizes[r.shard] += r["size"]
        places[texts[r.doc_id]].add(r.shard)
        slots[r.shard].append(r.slot)
    assert {r.law for r in got} == {"bytes"} and all(0 <= s < 24 for s in sizes) and all(sorted(v) == list(range(len(v))) for v in slots.values())
    share = sum(sizes.values()) / 24
    count = collections.Counter(t for t in texts.values())
    for text, shards in places.items():  # only a group beyond a shard may be cut
        assert len(shards) == 1 or count[text] * (len(slow.raw(text)) + 8) > share or count[text] > len(table) / 24 or count[text] * len(slow.WORD.findall(text or "")) > sum(len(slow.WORD.findall(t or "")) * n for t, n in count.items()) / 24
    largest = max(count[t] * (len(slow.raw(t)) + 8) for t in count)
    assert max(sizes.values()) <= max(1.05 * share, largest)


def test_op8(spark, sf_dir, table):
    got = {r.doc_id: r for r in run(spark, sf_dir, "op8_language")}
    langs = {lang for _, _, lang, _ in table}
    for doc_id, text, *_ in table:
        r = got[doc_id]
        assert r.held_out == (zlib.crc32(str(doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1
        assert r.lang_pred in langs if any(ch.isalpha() for ch in text or "") else (r.lang_pred, r.score) == ("und", 0)
    held = [(got[i].lang_pred, lang) for i, _, lang, _ in table if got[i].held_out and lang and got[i].lang_pred != "und"]
    assert sum(a == b for a, b in held) >= 0.98 * len(held)


def test_op9(spark, sf_dir, table):
    got = {r.doc_id: r for r in run(spark, sf_dir, "op9_mixing")}
    sizes, taken = collections.Counter(), collections.Counter()
    for doc_id, text, _, source in table:
        r, n = got[doc_id], len(slow.WORD.findall(text or ""))
        assert r["size"] == n and 0 <= r.taken <= 2 * n
        sizes[source] += n
        taken[source] += r.taken
    for source, target in slow.water_fill(sizes).items():
        assert abs(taken[source] - target) <= 1
        assert all(got[i].source_size == sizes[source] and abs(got[i].target - target) < 1e-6 * max(1, target) for i, *_, s in table if s == source)


def test_op10(spark, sf_dir):
    sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
    import oracle

    assert oracle.difference(spark, sf_dir, queries.QUERIES["op10_suffix_dedup"], queries.ORACLE_SQL["op10_suffix_dedup"]) == ""


def test_all_are_registered():
    import __spark_entry__

    assert set(queries.QUERIES) <= set(__spark_entry__.queries()) and len(queries.QUERIES) == 11 and os.path.exists(Path(__file__).resolve().parents[2] / "corpus_pipeline.py")
    assert np.all([q.startswith("op") or q == "pipeline" for q in queries.QUERIES])
