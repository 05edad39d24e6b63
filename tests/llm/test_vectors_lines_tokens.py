"""Hard negatives, line dedup and token alignment against brute force, awkward rows included."""

import hashlib
import random
from collections import Counter, defaultdict
from math import floor, isfinite

import numpy as np
import public_tokenizers
import pytest

from adloom.llm import hard_negatives, line_dedup, token_alignment
from adloom.session import scratch_dir


def test_hilbert_curve_visits_neighbours():
    for axes, bits in ((2, 3), (3, 2)):
        side = np.arange(1 << bits)
        cells = np.stack(np.meshgrid(*[side] * axes), axis=-1).reshape(-1, axes)
        place = hard_negatives.hilbert(cells, bits)
        assert sorted(place) == list(range(len(cells)))
        assert np.all(np.abs(np.diff(cells[np.argsort(place)], axis=0)).sum(axis=1) == 1)


def mined_by_brute_force(rows, every=50, positives=5, negatives=3):
    used = [(i, [floor(256 * x) for x in v], k) for i, v, k, *_ in rows
            if v is not None and k is not None and all(x is not None and isfinite(x) and abs(floor(256 * x)) < 1 << 24 for x in v)]
    last, out = float("inf"), []
    for anchor, a, label in used:
        if anchor is None or anchor % every:
            continue
        scored = sorted(((-sum(x * y for x, y in zip(a, v, strict=True)), last if i is None else i, i, k) for i, v, k in used if len(v) == len(a)), key=lambda x: x[:2])
        for minus, _, pid, _ in [x for x in scored if x[3] == label and x[2] != anchor][:positives]:
            hits = [x for x in scored if x[3] != label and -50 * minus <= -100 * x[0] <= -95 * minus][:negatives]
            out += [(anchor, pid, r + 1, x[2], -minus, -x[0]) for r, x in enumerate(hits)]
    return sorted(out, key=repr)


VECTORS = "vec_id long, embedding array<float>, label int, score long, part string, q string"


def vectors(n=700, width=6, seed=3):
    rng = random.Random(seed)
    rows = [[i, [rng.gauss(0, 0.4) for _ in range(width)], i % 3] for i in range(n)]
    same = rows[5][1]
    for k in range(0, n, 3):  # a third of the rows hold one vector
        rows[k][1] = same
    rows[7][1], rows[8][2], rows[9][1], rows[10][1] = None, None, [float("nan")] + [0.1] * (width - 1), [None] * width
    rows[11][1], rows[50][1], rows[52][1] = [float("inf")] * width, [], []
    rows[100][1], rows[101][1], rows[102][1] = [0.5, 0.25], [0.5, 0.25], [0.25, 0.25]
    rows[150][1], rows[13][1] = [300.5] * width, [70000.0] * width
    rows += [[200, rows[200][1], 1], [200, rows[201][1], 2], [250, rows[250][1], rows[250][2]], [None, same, 0], [None, rows[61][1], 1], [-50, rows[62][1], 2]]
    return [(*r, 1, "p", "q") for r in rows]


def test_hard_negatives(spark, monkeypatch):
    rows = vectors()
    table = spark.createDataFrame(rows, VECTORS).repartition(3)
    expected = mined_by_brute_force([(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v], k) for i, v, k, *_ in rows])
    assert len(expected) > 60
    found = hard_negatives.mine(table)
    assert found.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert sorted(map(tuple, found.collect()), key=repr) == expected
    monkeypatch.setattr(hard_negatives, "ANCHOR_BYTES", 24 * 6)  # six anchors a chunk
    assert sorted(map(tuple, hard_negatives.mine(table).collect()), key=repr) == expected


def test_hard_negatives_of_nothing(spark):
    none = spark.createDataFrame([], VECTORS)
    assert hard_negatives.mine(none).collect() == []
    assert hard_negatives.mine(spark.createDataFrame([(1, [0.5], 1, 1, "", ""), (50, None, 1, 1, "", "")], VECTORS)).collect() == []


def test_zone_bounds_hold_and_skip(spark):
    rng = np.random.default_rng(1)
    q = rng.integers(-60, 60, (40, 5)).astype(np.int64)
    block = rng.integers(20, 40, (30, 5)).astype(np.int64)
    block[:, 1] -= 30
    a = hard_negatives.Anchors(np.arange(40), np.arange(40), np.zeros(40, int), q, np.full((40, 1), 200), np.full((40, 1), 900), False, 3)
    low, high = a.ranges(block.min(axis=0), block.max(axis=0))
    scores = q @ block.T
    assert np.all(scores >= low[:, None]) and np.all(scores <= high[:, None])
    wanted = a.wanting(1, block.min(axis=0), block.max(axis=0), a.low)[:, 0]
    assert not wanted.all() and np.all(wanted | ~((scores >= 200) & (scores <= 900)).any(axis=1))
    assert not a.wanting(0, block.min(axis=0), block.max(axis=0), a.low).any()


def test_zone_maps_leave_parts_unread(spark):
    """Clusters far apart: the windows of anchors of one cluster lead to its own parts alone."""
    rng = np.random.default_rng(2)
    centres = np.eye(8)
    rows = [(int(i), [float(x) for x in centres[i % 8] + rng.normal(0, 0.02, 8)], int(i // 8 % 2)) for i in range(1, 4001)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    path = scratch_dir(spark, "zones")
    hard_negatives.write_blocks(table, path)
    zones = spark.read.parquet(f"{path}/zones").toArrow().to_pylist()
    anchor = np.floor(256 * np.array([rows[49][1]])).astype(np.int64)
    one = hard_negatives.Anchors(np.zeros(1, int), np.array([50]), np.array([rows[49][2]]), anchor, np.array([[20000]]), np.array([[60000]]), False, 3)
    wanted = [z for z in zones if one.wanting(*hard_negatives._zone(z), one.low).any()]
    assert wanted and len(wanted) < len(zones) / 3


def lines_by_brute_force(texts, limit=10, least=1):
    keys = [[x.strip(" \t\n\x0b\x0c\r").translate({c: c + 32 for c in range(65, 91)}) for x in (t or "").split("\n")] for t in texts]
    held = Counter(k for own in keys for k in set(own) if len(k) >= least)
    out = []
    for t, own in zip(texts, keys, strict=True):
        lines = (t or "").split("\n")
        kept = [x for x, k in zip(lines, own, strict=True) if held[k] < limit]
        out.append((len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def line_texts(n=60, seed=4):
    rng = random.Random(seed)
    shared = ["Licence: MIT", "  licence: mit\t", "SHARED É line", "shared É line", "日本", "x", "", " ", "\x0bTab\x0c", "\x1fkept\x1f", "rare line"]
    texts = ["\n".join(rng.choice(shared) if rng.random() < 0.6 else f"own {rng.random()}" for _ in range(rng.randrange(0, 12))) for _ in range(n)]
    return [None, "", "\n", "\n\n", "x\nx\nX", "long line " * 30_000 + "\nlicence: MIT", *texts, *texts[:3]]


LINES = "doc_id long, text string, n_lines string, row string, k1 long, N_DROPPED int"


def line_rows(spark, texts, first=0):
    return spark.createDataFrame([(None if k % 7 == 3 else k, t, "a", "b", 1, 2) for k, t in enumerate(texts, first)], LINES).repartition(3)


def cut_rows(index, docs, **more):
    found = index.cut(docs, **more)
    assert found.columns == ["doc_id", "text", "row", "k1", "n_lines", "n_dropped", "kept_text"]
    return sorted(((r.text, (r.n_lines, r.n_dropped, r.kept_text)) for r in found.collect()), key=repr)


def expected_cut(texts, **more):
    return sorted(zip(texts, lines_by_brute_force(texts, **more), strict=True), key=repr)


def test_cuckoo_filter_grows_and_forgets():
    rng = np.random.default_rng(0)
    keys = np.unique(rng.integers(-(1 << 62), 1 << 62, (20_000, 2)), axis=0)
    made = line_dedup.CuckooFilter.holding(keys[:10_000])
    assert made.holds(keys[:10_000]).all() and made.holds(keys[10_000:]).mean() < 1e-3
    made.remove(keys[:4_000])
    assert made.holds(keys[4_000:10_000]).all() and made.holds(keys[:4_000]).mean() < 1e-3
    assert made.insert(keys[10_000:12_000]) and made.holds(keys[4_000:12_000]).all()
    assert not line_dedup.CuckooFilter(4).insert(keys[:100])
    assert tuple(keys[5_000].tolist()) in made


def test_line_index_whole(spark):
    texts = line_texts()
    docs = line_rows(spark, texts)
    index = line_dedup.LineIndex(spark, scratch_dir(spark, "lines"))
    index.add(docs)
    assert sum(n for _, (_, n, _) in expected_cut(texts)) > 100
    assert cut_rows(index, docs) == expected_cut(texts)
    assert cut_rows(index, docs, filter_bytes=0) == expected_cut(texts)
    longer = line_dedup.LineIndex(spark, scratch_dir(spark, "lines"), limit=3, least_chars=2, shards=2)
    longer.add(docs)
    assert cut_rows(longer, docs) == expected_cut(texts, limit=3, least=2)


def test_line_index_is_reversible(spark):
    """Batches that come and go leave what one load of the remaining documents gives."""
    texts = line_texts(90)
    batches = [texts[:40], texts[40:70], texts[70:]]
    path = scratch_dir(spark, "lines")
    index = line_dedup.LineIndex(spark, path, shards=2)
    for batch in batches:
        index.add(line_rows(spark, batch))
    assert cut_rows(index, line_rows(spark, texts)) == expected_cut(texts)
    again = line_dedup.LineIndex.open(spark, path)
    again.remove(line_rows(spark, batches[1]))
    left = batches[0] + batches[2]
    assert cut_rows(again, line_rows(spark, left)) == expected_cut(left)
    held = again.filters().where("held IS NOT NULL").collect()
    common = [tuple(r) for r in again.common().collect()]
    assert common and all(any(k in line_dedup._restored(r.buckets, bytes(r.held)) for r in held if r.shard == k[0] % 2) for k in common)
    whole = line_dedup.LineIndex(spark, scratch_dir(spark, "lines"))
    whole.add(line_rows(spark, left))
    assert sorted(map(tuple, whole.counts().collect())) == sorted(map(tuple, again.counts().collect()))
    assert len(line_dedup.LineIndex.open(spark, path).runs) <= 3
    again.remove(line_rows(spark, left))
    assert again.counts().collect() == [] and again.common().collect() == []


def test_filters_that_run_full_are_built_anew(spark):
    rows = lambda a, b: line_rows(spark, ["\n".join(f"line {k}" for k in range(a, b))] * 2)
    index = line_dedup.LineIndex(spark, scratch_dir(spark, "lines"), limit=2, shards=1)
    index.add(rows(0, 10))
    before = index.filters().first().buckets
    index.add(rows(10, 500))
    assert index.filters().first().buckets > before
    assert [r.n_dropped for r in index.cut(rows(0, 500)).collect()] == [500, 500]


def test_line_index_of_nothing(spark):
    none = spark.createDataFrame([], LINES)
    index = line_dedup.LineIndex(spark, scratch_dir(spark, "lines"))
    index.add(none)
    assert index.cut(none).collect() == [] and index.counts().collect() == []
    index.add(line_rows(spark, ["a"] * 10))
    assert [r.kept_text for r in index.cut(line_rows(spark, ["a"] * 10)).collect()] == [""] * 10


A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def aligned_by_brute_force(texts):
    import sentencepiece
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(A)
    model.encode_special_tokens = True
    pieces = sentencepiece.SentencePieceProcessor(model_file=B)
    signs = {chr(b): b for b in [*range(33, 127), *range(161, 173), *range(174, 256)]}
    signs.update({chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in set(signs.values()))})

    def of_piece(i):
        p = pieces.id_to_piece(i)
        return bytes([int(p[3:-1], 16)]) if pieces.is_byte(i) else p.replace("▁", " ").encode()

    found, held = [], defaultdict(set)
    for n, text in enumerate(texts):
        rows = None
        if text:
            a = model.encode(" " + text, add_special_tokens=False)
            spans = [[(i, bytes(signs[c] for c in t)) for i, t in zip(a.ids, a.tokens, strict=True)], [(i, of_piece(i)) for i in pieces.encode(text)]]
            if all(b"".join(t for _, t in own) == (" " + text).encode() for own in spans):
                rows = []
                for own in spans:
                    end, out = 0, []
                    for i, t in own:
                        out.append((i, end, end + len(t)))
                        end += len(t)
                    rows.append(out)
        found.append(rows)
        if rows:
            a, b = rows
            links, k = [], 0
            for i, s, e in a:
                while b[k][2] <= s:
                    k += 1
                m = k
                while m < len(b) and b[m][1] < e:
                    links.append((i, b[m][0]))
                    m += 1
            rows.append(links)
            for pair in links:
                held[pair].add(n)
    best = defaultdict(int)
    for (i, _), own in held.items():
        best[i] = max(best[i], len(own))
    out = []
    for rows in found:
        if not rows:
            out.append((0, 0, 0, 0, 0, 0, ""))
            continue
        a, b, links = rows
        cuts = sorted({e for _, _, e in a} & {e for _, _, e in b})
        parts, start = [], 0
        by_end = [{e: k for k, (_, _, e) in enumerate(own, 1)} for own in (a, b)]
        pa = pb = 0
        for c in cuts:
            na, nb = by_end[0][c], by_end[1][c]
            parts.append(",".join(str(x[0]) for x in a[pa:na]) + "|" + ",".join(str(x[0]) for x in b[pb:nb]))
            pa, pb = na, nb
        out.append((len(a), len(b), len(cuts), len(links), sum(len(held[x]) == best[x[0]] for x in links), sum(len(held[x]) for x in links),
                    hashlib.sha256(";".join(parts).encode()).hexdigest()))
    return out


def alignment_texts():
    rng = random.Random(8)
    words = ["alpha", "beta's", "Größe", "日本語", "don't", "123456", "🙂", "naïve", "\n\n", "  ", "<|endoftext|>", "<s>", "</s>", "<0x0A>", "x" * 40, "\t"]
    texts = [" ".join(rng.choices(words, k=rng.randrange(1, 40))) for _ in range(40)]
    return [None, "", " ", "  ", "a", " a", "a ", "a  b", "\x00\x01", "▁▁", "é" * 300, "word " * 30_000 + "日本" * 4000, "▁x y", *texts, *texts[:3]]


@pytest.mark.parametrize("pairs", [token_alignment.PAIRS, 0])
def test_alignment(spark, pairs):
    texts = alignment_texts()
    schema = "doc_id long, text string, N_A string, number long, code long, row string"
    docs = spark.createDataFrame([(None if k % 5 == 1 else k, t, "n", 1, 2, "r") for k, t in enumerate(texts)], schema).repartition(3)
    found = token_alignment.align(docs, A, B, pairs=pairs)
    assert found.columns == ["doc_id", "text", "number", "code", "row", *token_alignment.RESULTS]
    expected = aligned_by_brute_force(texts)
    assert sum(x[0] == 0 for x in expected) < 10
    assert sorted(((r.text, tuple(r[5:])) for r in found.collect()), key=repr) == sorted(zip(texts, expected, strict=True), key=repr)
    assert token_alignment.align(spark.createDataFrame([], schema), A, B, pairs=pairs).collect() == []


def test_lanes_change_nothing():
    rng = random.Random(2)
    a, b = token_alignment._loaded(A, B)
    text = " ".join("".join(rng.choices("abcdefé日", k=rng.randrange(1, 9))) for _ in range(3000))
    whole = token_alignment.Aligned([text, "x", None], a, b)
    assert len(token_alignment._lanes(np.cumsum(a.lengths[whole.a[: whole.first_a[1]]]), np.cumsum(b.lengths[whole.b[: whole.first_b[1]]]))[0]) > 5
    ends_a, ends_b = np.cumsum(a.lengths[whole.a]), np.cumsum(b.lengths[whole.b])
    one = token_alignment.lockstep(ends_a, ends_b, np.array([0]), np.array([0]), np.array([len(whole.a)]))
    assert all(np.array_equal(x, y) for x, y in zip(one, (whole.link_a, whole.link_b, whole.cut_a, whole.cut_b), strict=True))
