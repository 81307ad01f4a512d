"""Token alignment, the conversation trie and the shards, against brute force."""

import collections
import hashlib
import json
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from ledgerlens.llm import alignment, queries, shards, trie
from llm_fixtures import SF001, odd  # noqa: F401

DOC = "doc_id long, text string"


# ---------------------------------------------------------------- token alignment

def align_by_hand(docs):
    """The contract of the alignment, text by text: (doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, sha)."""
    import sentencepiece
    from tokenizers import Tokenizer
    path_a, path_b = queries.vocabulary(), queries.vocabulary("piece_bpe_32k.model")
    a = Tokenizer.from_file(path_a)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=path_b)
    names = {i: t for t, i in a.get_vocab().items()}
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    stand = {chr(c): c for c in plain} | {chr(256 + k): c for k, c in enumerate(c for c in range(256) if c not in plain)}
    piece = lambda i: bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()
    rows, held = [], collections.Counter()
    for doc_id, text in docs:
        groups, raw = [], (" " + (text or "")).encode()
        if text:
            ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
            bytes_a, bytes_b = [bytes(stand[c] for c in names[i]) for i in ids_a], [piece(i) for i in ids_b]
            if b"".join(bytes_a) == raw == b"".join(bytes_b):
                ends_a = np.cumsum([len(x) for x in bytes_a]).tolist()
                ends_b = np.cumsum([len(x) for x in bytes_b]).tolist()
                from_a = from_b = 0
                for e in sorted(set(ends_a) & set(ends_b)):
                    to_a, to_b = ends_a.index(e, from_a) + 1, ends_b.index(e, from_b) + 1
                    groups.append((ids_a[from_a:to_a], ids_b[from_b:to_b]))
                    from_a, from_b = to_a, to_b
        links = [(x, y) for g in groups for x in g[0] for y in g[1]]
        held.update(set(links))
        rows.append((doc_id, groups, links))
    highest = collections.defaultdict(int)
    for (x, _), n in held.items():
        highest[x] = max(highest[x], n)
    out = []
    for doc_id, groups, links in rows:
        text = ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in groups)
        out.append((doc_id, sum(len(x) for x, _ in groups), sum(len(y) for _, y in groups), len(groups), len(links),
                    sum(held[p] == highest[p[0]] for p in links), sum(held[p] for p in links),
                    hashlib.sha256(text.encode()).hexdigest() if groups else ""))
    return out


def hard_texts():
    rnd = random.Random(5)
    words = ["the", "straße", "日本語テキスト", "x9", "don't", "　", "  ", "\n\n", "\t", "aaaaaaaaa", "😀😀", "<|endoftext|>", "<s>", "<0x41>",
             "é", " ", "12345", "http://a.b/c?d=e", "\x00", " ", "ﬁ", "İ", "\x1c", "\x85"]
    texts = [None, "", " ", "  two", "trailing  ", "▁piece", "plain words only", "plain words only"]
    texts += ["".join(rnd.choice(words) + rnd.choice([" ", "", "  ", " "]) for _ in range(rnd.randint(1, 60))) for _ in range(120)]
    texts += ["Zz" * 700 + " end", "日本語" * 400, " ".join(f"w{i % 91}" for i in range(900)), "bad ▁ " + "word " * 300]
    return list(enumerate(texts))


@pytest.mark.parametrize("span, fan", [(alignment.RANGE, alignment.FAN), (64, 2), (7, 3)])
def test_alignment_equals_brute_force(spark, span, fan):
    """Also with tiny byte ranges, so that groups cross them and the reduction has many rounds."""
    docs = hard_texts()
    got = alignment.align_documents(spark.createDataFrame(docs, DOC).repartition(5), queries.vocabulary(),
                                    queries.vocabulary("piece_bpe_32k.model"), span=span, fan=fan)
    assert sorted(map(tuple, got.collect())) == sorted(align_by_hand(docs))


def test_alignment_of_the_table_in_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(alignment, "BLOCK_GROUPS", 300)
    docs = [tuple(r) for r in spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted(map(tuple, queries.op11_alignment(spark, SF001).collect())) == sorted(align_by_hand(docs))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 5), st.integers(1, 5)), min_size=1, max_size=40), st.integers(1, 9), st.randoms())
def test_fragments_compose_in_any_tree(shape, span, rnd):
    size_a = [0, 1, 2, 3, 4, 5]
    a, b = [x for x, _ in shape], [y for _, y in shape]
    short, gap = (a, b)[sum(a) > sum(b)], abs(sum(a) - sum(b))
    short += [1] * gap                              # the same bytes on both sides
    whole = alignment.grouped(a, b, size_a, size_a).split(";")
    found = [f for _, f in alignment.fragments(whole, 0, size_a, size_a, span)]
    while len(found) > 1:
        i = rnd.randrange(len(found) - 1)
        found[i:i + 2] = [found[i] + found[i + 1]]
    assert list((alignment.Fragment() + found[0] + alignment.Fragment()).groups()) == whole


def test_alignment_odd_cases(spark, odd):  # noqa: F811
    got = [tuple(r) for r in alignment.align_documents(odd, queries.vocabulary(), queries.vocabulary("piece_bpe_32k.model")).collect()]
    assert sorted(got, key=repr) == sorted(align_by_hand([(r.doc_id, r.text) for r in odd.collect()]), key=repr)
    assert alignment.align_documents(odd.limit(0), queries.vocabulary(), queries.vocabulary("piece_bpe_32k.model")).collect() == []


# ---------------------------------------------------------------- conversation trie

def trie_by_hand(rows):
    """Nodes of the contract's trie of rows (conv_id, turn, role, text)."""
    said = collections.defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()[:16]
            said[c].append((turn is not None, turn or 0, digest, role, text))
    said = {c: [t[3:] for t in sorted(ts)] for c, ts in said.items()}
    built = {}
    for c, own in said.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - int(np.fmod(c, 5))
        built[c] = tuple(said.get(base, [])[:h] + own[h:])
    members = collections.defaultdict(list)
    for c, ts in built.items():
        for d in range(len(ts) + 1):
            members[ts[:d]].append(c)
    out = []
    for node, convs in members.items():
        below = [m for m in members if m[:len(node)] == node]
        ends = sorted(c for c in convs if len(built[c]) == len(node))
        out.append((min(convs), len(node), min(members[node[:-1]]) if node else None, len(convs),
                    sum(len(m) == len(node) + 1 for m in below),
                    sum(not any(x[:-1] == m for x in members if x) for m in below),
                    sum((len(members[m]) - 1) * len(m[-1][1].encode()) for m in below if m),
                    hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return out


TURN = "conv_id long, turn long, role string, text string"


def conversations(seed, n=120):
    rnd = random.Random(seed)
    rows = []
    for c in range(-11, n):
        if rnd.random() < 0.1:
            continue
        for t in range(rnd.randint(1, 12)):
            first = t < 2 and rnd.random() < 0.7
            rows.append((c, t if rnd.random() > 0.05 else None, rnd.choice(["user", "assistant", None]) if not first else "system",
                         "hello" if first else rnd.choice(["é", "b", "", None, "long text"])))
    rows += [(9_223_372_036_854_775_805, 0, "user", "far"), (-9_223_372_036_854_775_805, 0, "user", "far"), (None, 0, "user", "no id")]
    return rows + rnd.sample(rows, 10)


@pytest.mark.parametrize("seed, fewest, queued", [(1, 3, 2), (2, 1000, 10), (3, 20, 1)])
def test_trie_equals_brute_force(spark, seed, fewest, queued, monkeypatch):
    """With few and many heavy nodes, and queues that spill at every message."""
    monkeypatch.setattr(trie.math, "isqrt", lambda n: 0)
    monkeypatch.setattr(trie, "ID_BITS", 3)
    rows = conversations(seed)
    got = trie.prefix_trie(spark.createDataFrame(rows, TURN).repartition(4), queued=queued, fewest=fewest)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(trie_by_hand(rows), key=repr)


def test_trie_of_copies_and_none(spark):
    rows = [(c, t, "user", f"turn {t}") for c in range(400) for t in range(3)]
    got = trie.prefix_trie(spark.createDataFrame(rows, TURN), fewest=50)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(trie_by_hand(rows), key=repr)
    assert trie.prefix_trie(spark.createDataFrame([], TURN)).collect() == []
    assert trie.prefix_trie(spark.createDataFrame([(None, 1, "user", "x")], TURN)).collect() == []


def test_trie_matches_its_sql(spark):
    from oracle_compare import compare
    ok, msg = compare(spark, "op12_prefix_trie", queries.op12_prefix_trie, queries.ORACLES["op12_prefix_trie"], SF001)
    assert ok, msg


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.integers(-5, 5), st.binary(max_size=2)), max_size=60), st.integers(1, 8))
def test_spilling_queue_is_a_priority_queue(items, limit):
    q = trie.SpillingQueue(limit)
    got, waiting = [], []
    for k, item in enumerate(items):
        q.push(item)
        waiting.append(item)
        if k % 3 == 2:
            got.append((q.least(), q.pop(), min(waiting)))
            waiting.remove(min(waiting))
    while q.least() is not None:
        got.append((q.least(), q.pop(), min(waiting)))
        waiting.remove(min(waiting))
    assert not waiting and all(a == b == c for a, b, c in got)


# ---------------------------------------------------------------- shards

@pytest.mark.parametrize("n", [1, 2, 3, 24, 25, 255, 257, 5000])
def test_permutation_and_its_inverse(n):
    p = shards.Permutation(n, 7)
    at = p.forward(np.arange(n))
    assert sorted(at.tolist()) == list(range(n))
    assert p.inverse(at).tolist() == list(range(n))
    shard, slot = shards.locate(np.arange(n), n, 5, 7)
    assert shards.row_at(shard, slot, n, 5, 7).tolist() == list(range(n))
    with pytest.raises(ValueError):
        shards.row_at(0, n, n, 5, 7)


def test_permutation_is_keyed_and_mixes():
    a, b = (shards.Permutation(100_000, s).forward(np.arange(100_000)) for s in (1, 2))
    assert (a == b).mean() < 0.001
    near = np.abs(np.diff(a))
    assert 25_000 < near.mean() < 42_000            # neighbours end up a third of the table apart


def shards_by_hand(rows, n_shards=24):
    """(doc_id, size, crc, shard, slot) with Python's own integers, one number at a time."""
    mask64 = (1 << 64) - 1

    def mix(x):
        x = ((x ^ x >> 30) * 0xBF58476D1CE4E5B9) & mask64
        x = ((x ^ x >> 27) * 0x94D049BB133111EB) & mask64
        return x ^ x >> 31

    n = len(rows)
    half = max(1, ((n - 1).bit_length() + 1) // 2)
    keys = [mix((shards.SEED + (k + 1) * 0x9E3779B97F4A7C15) & mask64) for k in range(shards.ROUNDS)]

    def once(x):
        left, right = x >> half, x & (1 << half) - 1
        for k in keys:
            left, right = right, left ^ mix(right ^ k) & (1 << half) - 1
        return left << half | right

    out = []
    facts = [(i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in rows]
    for number, (i, size, crc) in enumerate(sorted(facts, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))):
        x = once(number)
        while x >= n:
            x = once(x)
        out.append((i, size, crc, x % n_shards, x // n_shards))
    return out


def test_shards_equal_brute_force_at_any_layout(spark, odd, monkeypatch):  # noqa: F811
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = sorted((r.doc_id, r.size, r.text_crc32, r.shard, r.slot) for r in queries.op13_feistel_shards(spark, SF001).collect())
    assert got == sorted(shards_by_hand(rows))
    again = shards.placements(docs.repartition(7).select("text", "doc_id"))
    assert sorted((r.id, r.size, r.text_crc32, r.shard, r.slot) for r in again.collect()) == got
    monkeypatch.setattr(shards, "BLOCK", 1)          # equal rows spread in blocks
    placed = shards.placements(odd.select("doc_id", "text").unionAll(odd.select("doc_id", "text")))
    got = sorted(((r.id, r.size, r.text_crc32, r.shard, r.slot) for r in placed.collect()), key=repr)
    assert got == sorted(shards_by_hand([(r.doc_id, r.text) for r in odd.collect()] * 2), key=repr)
    assert shards.placements(odd.limit(0)).collect() == []


def test_shards_are_even_and_gapless(spark):
    docs = spark.range(0, 5003).selectExpr("IF(id % 3 = 0, NULL, id) doc_id", "IF(id % 3 = 0, 'same', CAST(id AS STRING)) text")
    slots = collections.defaultdict(list)
    for r in shards.placements(docs, 24).collect():
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert len(slots) == 24 and {len(s) for s in slots.values()} <= {5003 // 24, 5003 // 24 + 1}


def test_written_shards_hold_whole_rows_in_order(spark, odd, tmp_path):  # noqa: F811
    rows = odd.withColumnRenamed("range", "id range")
    shards.write_shards(rows, str(tmp_path / "out"), 3)
    back = spark.read.parquet(str(tmp_path / "out"))
    key = lambda df: sorted(json.dumps(r.asDict(), sort_keys=True) for r in df.select(rows.columns).collect())
    assert key(back) == key(rows)
    for k in range(3):
        seen = [r.slot for r in spark.read.parquet(str(tmp_path / "out" / f"shard={k}")).collect()]
        assert sorted(seen) == list(range(len(seen)))
    with pytest.raises(ValueError):
        shards.write_shards(rows.withColumn("Slot", rows["doc_id"]), str(tmp_path / "no"))
