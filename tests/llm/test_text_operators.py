"""Operators on documents against brute force: repeats, near-duplicates, decontamination,
packing, statistics. Each runs over awkward rows as well."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from adloom.session import scratch_dir
from adloom.llm import bag_minhash, components, decision_list, decontaminate, packing, suffix_dedup, textops

SCHEMA = "doc_id long, text string, _id string, key long, c0 string, n_words string"


def awkward() -> list[tuple]:
    """Nulls, empties, long and repeated texts, ties, repeated ids, multi-byte signs."""
    rng = random.Random(5)
    words = ["alpha", "beta", "gamma", "délta", "eps", "日本", "zeta!", "x"]
    text = lambda n: " ".join(rng.choices(words, k=n)) if n else ""
    passage, base = text(60), text(150)
    texts = [None, "", " ", "x", "!!", text(4), text(9000), passage, base, base, base + " tail", "lead " + base,
             base.replace("alpha", "omega", 1), text(40) + "\n" + passage + "\n" + text(30), "q" * 500, "q" * 350, "ab" * 300,
             passage + " " + passage, "\n".join(["same line"] * 30), text(30), text(25), "日" * 200]
    rows = [(i, t) for i, t in enumerate(texts)] + [(8, base), (8, base), (None, base), (None, None), (3, "other text of a used id")]
    return [(i, t, "a", None if k % 2 else k, "c", "n") for k, (i, t) in enumerate(rows)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(awkward(), SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def repeats_by_brute_force(texts: list[bytes], n: int) -> list[tuple]:
    seen = Counter(t[i : i + n] for t in texts for i in range(len(t) - n + 1))
    out = []
    for t in texts:
        mark = bytearray(len(t))
        for i in range(len(t) - n + 1):
            if seen[t[i : i + n]] > 1:
                mark[i : i + n] = b"\1" * n
        kept = bytes(b for b, m in zip(t, mark, strict=True) if not m)
        out.append((len(t), sum(mark), len(re.findall(b"\1+", bytes(mark))), hashlib.sha256(kept).hexdigest()))
    return out


def test_hash_of_equal_spans_is_equal():
    data = np.frombuffer(b"abcabcabcX", dtype=np.uint8)
    h = textops.SpanHashes(data)
    assert h.of(np.array([0, 3]), np.array([6, 9])).tolist()[0] == h.of(np.array([3]), np.array([9]))[0]
    assert len(set(h.of_length(3).tolist())) == 4
    assert textops.sliding_min(np.array([5, 3, 4, 1, 7], dtype=np.uint64), 3).tolist() == [3, 1, 1]


@pytest.mark.parametrize("n", [40, 200])
def test_repeats(spark, docs, n):
    rows = awkward()
    want = Counter(repeats_by_brute_force([(r[1] or "").encode() for r in rows], n))
    got = suffix_dedup.cut_repeats(docs, min_bytes=n)
    assert got.columns == [*docs.columns, "n_bytes", "n_removed", "n_spans"]
    assert Counter(tuple(r) for r in got.select("n_bytes", "n_removed", "n_spans", F.sha2("text", 256)).collect()) == want


def test_repeats_with_split_groups(spark, monkeypatch):
    """Many stretches under one prefix are compared in splits by offset."""
    monkeypatch.setattr(suffix_dedup, "STRETCHES_PER_GROUP", 3)
    rng = random.Random(1)
    noise = lambda n: "".join(rng.choices("abcdefgh ", k=n))
    core = noise(90)
    sides = [noise(70) for _ in range(6)]
    texts = [rng.choice(sides)[-rng.randint(5, 70):] + core + rng.choice(sides)[: rng.randint(5, 70)] for _ in range(60)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.h) for r in
           suffix_dedup.cut_repeats(frame, min_bytes=120).select("*", F.sha2("text", 256).alias("h")).collect()}
    assert [got[i] for i in range(60)] == repeats_by_brute_force([t.encode() for t in texts], 120)


def test_no_task_gathers_a_common_line(spark, monkeypatch):
    """Of a line in very many texts, a group in one task holds few stretches."""
    monkeypatch.setattr(suffix_dedup, "STRETCHES_PER_GROUP", 20)
    rng = random.Random(2)
    noise = lambda n: "".join(rng.choices("abcdefgh ", k=n))
    line, near = noise(100), [noise(60) for _ in range(2)]
    texts = [noise(150) + line + noise(150) for _ in range(150)] + [noise(80) + near[k % 2] + line + noise(90) for k in range(6)]
    gathered = suffix_dedup._edge_spans

    def checked(batches, min_bytes):  # runs in the workers
        batches = list(batches)
        keys = Counter(k for b in batches for k in b.column("key").to_pylist())
        assert max(keys.values(), default=0) <= 20
        yield from gathered(iter(batches), min_bytes)

    monkeypatch.setattr(suffix_dedup, "_edge_spans", checked)
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.h) for r in
           suffix_dedup.cut_repeats(frame, min_bytes=120).select("*", F.sha2("text", 256).alias("h")).collect()}
    assert [got[i] for i in range(len(texts))] == repeats_by_brute_force([t.encode() for t in texts], 120)
    assert sum(n for _, n, *_ in got.values()) > 0


def classes_by_brute_force(texts: list[str | None]) -> list[int]:
    bags = []
    for t in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        bags.append(Counter(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else Counter())
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(texts)):
        for b in range(a):
            both = sum((bags[a] & bags[b]).values())
            if both and both >= 0.8 * (sum(bags[a].values()) + sum(bags[b].values()) - both):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return [find(x) for x in range(len(texts))]


def test_near_duplicates(spark):
    texts = [r[1] for r in awkward()]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r._id: r.class_id for r in bag_minhash.near_duplicates(frame).collect()}
    assert [got[i] for i in range(len(texts))] == classes_by_brute_force(texts)


def test_near_duplicates_on_awkward_ids(docs):
    found = bag_minhash.near_duplicates(docs).collect()
    assert len(found) == len(awkward())
    assert sum(r.class_id == 8 for r in found) >= 6


def test_one_head_of_each_class(spark):
    """Copies and near copies under the same id, null ids among them."""
    rng = random.Random(6)
    base = [[f"w{k}x{i}" for i in range(200)] for k in range(3)]
    near = lambda k: " ".join(rng.sample(["other"], 1) + base[k][rng.randrange(1, 6) :])
    rows = [(None, near(0)) for _ in range(6)] + [(5, near(1)) for _ in range(6)] + [(k % 2 or None, near(2)) for k in range(6)]
    rows += [(5, rows[7][1]), (None, rows[0][1]), (None, None), (9, "")]
    found = bag_minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    heads = found.where("head and n_shingles > 0").select("_id", "_h").distinct().collect()
    assert sorted((r._id or 0) for r in heads) == [0, 1, 5]
    assert found.where("n_shingles = 0 and head").count() == 2
    assert {r.class_id for r in found.where("n_shingles > 0").collect()} == {None, 5, 1}


def test_suffix_index_over_batches(spark):
    """Batches added one after another, the index opened again between, give what one run over all gives."""
    rng = random.Random(13)
    passages = ["".join(rng.choices("abcdefgh ", k=260)) for _ in range(6)]
    texts = ["".join(rng.choices("abcdefgh ", k=rng.randrange(0, 500))) + rng.choice(["", *passages]) + "".join(rng.choices("ijkl ", k=rng.randrange(0, 300))) for _ in range(60)]
    texts += [None, "", texts[3], texts[3]]
    frame = lambda rows: spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string").repartition(3)
    path, seen = scratch_dir(spark, "suffix-index"), []
    for batch in (texts[:30], texts[30:34], texts[34:], []):
        index = suffix_dedup.SuffixIndex.open(spark, path) if seen else suffix_dedup.SuffixIndex(spark, path)
        index.add(frame(batch).where("doc_id >= 0"))
        seen += batch
        got = index.cut(frame(seen)).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("text", 256).alias("kept")).orderBy("doc_id").collect()
        assert [tuple(r)[1:] for r in got] == repeats_by_brute_force([(t or "").encode() for t in seen], 200)
    assert len(index.runs) <= 3 and sum(r.n_removed > 0 for r in got) > 20
    with pytest.raises(ValueError, match="min_bytes"):
        suffix_dedup.SuffixIndex(spark, path, 8)


def test_texts_with_one_32_bit_hash_are_told_apart(spark):
    """Null ids, and texts that a 32-bit hash would take for one: only the copied one is cut."""
    texts = spark.range(400_000).select(F.concat(F.lit("".join(random.Random(1).choices("abcdefgh ", k=250))), F.md5(F.col("id").cast("string"))).alias("text"))
    pair = (texts.groupBy(F.hash("text").alias("h")).agg(F.collect_list("text").alias("same")).where(F.size("same") > 1).first().same)
    tail = lambda t: t[250:] * 8
    one, other = (t[250:] for t in pair)
    assert one != other
    rows = [(None, pair[0]), (None, pair[1])]
    found = suffix_dedup.cut_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.n_bytes, r.n_removed, bytes(r.text).decode()) for r in found) == sorted((282, 250 + k, t[k:]) for t, k in ((one, _shared(one, other)), (other, _shared(one, other))))
    alone = [(None, pair[0]), (1, pair[0][:250] + "zz"), (None, tail(pair[1]))]
    kept = {r.n_bytes: r.n_removed for r in suffix_dedup.cut_repeats(spark.createDataFrame(alone, "doc_id long, text string")).collect()}
    assert kept[len(tail(pair[1]))] == repeats_by_brute_force([x[1].encode() for x in alone], 200)[2][1]


def _shared(a, b):
    k = 0
    while a[k] == b[k]:
        k += 1
    return k


def test_near_group_without_hub(spark):
    """Copies that differ from one another by more than from a few of them."""
    rng = random.Random(3)
    base = [f"w{i}" for i in range(120)]
    texts = []
    for _ in range(70):
        words = list(base)
        for at in rng.sample(range(120), rng.randint(1, 3)):
            words[at] = f"n{rng.random()}"
        texts.append(" ".join(words))
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r._id: r.class_id for r in bag_minhash.near_duplicates(frame).collect()}
    assert [got[i] for i in range(70)] == classes_by_brute_force(texts)


def test_bag_signature_estimates_weighted_jaccard():
    rng = np.random.default_rng(0)
    a, b = rng.integers(1, 9, 300), rng.integers(1, 9, 300)
    b[:60] = a[:60]
    text = np.repeat([0, 1], 300)
    element = textops.mix(np.tile(np.arange(300, dtype=np.uint64), 2))
    same = bag_minhash.bag_signatures(text, element, np.concatenate((a, b)), 2, 4096)
    assert abs((same[0] == same[1]).mean() - np.minimum(a, b).sum() / np.maximum(a, b).sum()) < 0.03


@pytest.mark.parametrize("edges", [[], [(1, 1)], [(i, i + 1) for i in range(30)] + [(50, 51), (51, 50)],
                                   [(5, 1), (9, 5), (9, 1), (8, 5), (8, 2), (5, 2)]])
def test_components(spark, edges):
    root = list(range(60))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for u, v in edges:
        x, y = find(u), find(v)
        root[max(x, y)] = min(x, y)
    got = {r.node: r.component for r in components.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {x: find(x) for u, v in edges if u != v for x in (u, v)}


def test_components_of_few_edges_take_few_tasks(spark):
    edges = spark.createDataFrame([(0, i) for i in range(1, 200)] + [(i, i + 1000) for i in range(100)], "u long, v long")
    tracker, found, tasks = spark.sparkContext.statusTracker(), {}, {}
    partitions = spark.conf.get("spark.sql.shuffle.partitions")
    for few in (components.FEW, 0):
        group = f"components-{few}"
        spark.sparkContext.setJobGroup(group, "")
        with_many = {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
        for name, value in with_many.items():
            spark.conf.set(name, value)
        try:
            found[few] = {tuple(r) for r in components.components(edges, few=few).collect()}
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", partitions)
            spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
            spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        stages = {s for j in tracker.getJobIdsForGroup(group) for s in tracker.getJobInfo(j).stageIds}
        tasks[few] = sum(info.numCompletedTasks for s in stages if (info := tracker.getStageInfo(s)))
    assert found[0] == found[components.FEW] == {(x, 0) for x in [*range(200), *range(1000, 1100)]}
    assert 2 * tasks[components.FEW] < tasks[0]


def items_by_brute_force(docs, items, window=10):
    windows: dict[tuple, set] = {}
    for name, text in items:
        w = decontaminate.item_words(text)
        n = min(window, len(w))
        for k in range(len(w) - n + 1 if w else 0):
            windows.setdefault(tuple(w[k : k + n]), set()).add("null" if name is None else str(name))
    sizes = sorted({len(k) for k in windows})
    out = []
    for text in docs:
        w, hit, found = decontaminate.item_words(text), set(), set()
        for n in sizes:
            for k in range(len(w) - n + 1):
                if tuple(w[k : k + n]) in windows:
                    hit.update(range(k, k + n))
                    found |= windows[tuple(w[k : k + n])]
        out.append((len(w), len(hit), sorted(found)))
    return out


@pytest.mark.parametrize("seed", range(4))
def test_item_matches(spark, monkeypatch, seed):
    rng = random.Random(seed)
    words = "abc" if seed % 2 else "abcdef"
    text = lambda n: " ".join(rng.choices(words, k=n))
    items = [(k, text(rng.choice([0, 1, 2, 3, 4, 5, 9, 10, 11, 15] if seed < 2 else [5, 9, 12, 14]))) for k in range(12)]
    items += [(3, "a b b c"), (None, "c c a b A"), (50, None)]
    docs = [text(rng.randint(0, 40)) for _ in range(50)] + [None, ""] + [f"x Y! {t or ''} z" for _, t in items]
    if seed == 3:
        monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 60)
    frame = spark.createDataFrame([(i, t, "h", "i") for i, t in enumerate(docs)], "doc_id long, text string, hits string, items string")
    found = decontaminate.match_items(frame.select("doc_id", "text"), spark.createDataFrame(items, "item_id long, text string"))
    got = {r.doc_id: (r.n_words, r.n, r["items"]) for r in found.withColumn("n", decontaminate._union_words()).collect()}
    assert [got[i] for i in range(len(docs))] == items_by_brute_force(docs, items)
    # What decontaminate leaves has no passage any more.
    clean = decontaminate.decontaminate(frame, spark.createDataFrame(items, "item_id long, text string"), max_coverage=0.6)
    assert clean.columns == frame.columns
    untouched = {i for i, (_, n, _) in enumerate(items_by_brute_force(docs, items)) if n == 0}
    kept = {r.doc_id: r.text for r in clean.collect()}
    assert untouched <= set(kept) and all(kept[i] == docs[i] for i in untouched)


def test_item_blocks_one_at_a_time(spark, monkeypatch):
    """Blocks are dropped before the next one comes; repeated and long items keep to the block's size."""
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 400)
    rng = random.Random(4)
    text = lambda n: " ".join(f"{rng.choice('abc')}{rng.randrange(9)}" for _ in range(n))
    items = [(k, text(14)) for k in range(40)] + [(7, text(900)), (8, "p q r")] + [(99, "one two three " * 5)] * 300
    docs = [text(12) + " " + items[k][1] + " " + items[k + 1][1] + " " + text(5) for k in range(8)] + [items[40][1], "x p q r y", "one two three " * 9, None] + [items[3][1]] * 20
    live, most, real = set(), [0], type(spark.sparkContext).broadcast

    def counted(context, value):
        shared = real(context, value)
        if value.ids:
            live.add(shared)
            most[0] = max(most[0], len(live))
            assert sum(len(w) + 1 for w in value.ids) < 8 * 400 and len(value.go) < 2_000
        end = shared.destroy
        shared.destroy = lambda *a: (live.discard(shared), end(*a))
        return shared

    monkeypatch.setattr(type(spark.sparkContext), "broadcast", counted)
    frame = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    found = decontaminate.match_items(frame, spark.createDataFrame(items, "item_id long, text string"))
    got = {r.doc_id: r for r in found.withColumn("n", decontaminate._union_words()).collect()}
    assert most == [1] and not live
    assert [(got[i].n_words, got[i].n, got[i]["items"]) for i in range(len(docs))] == items_by_brute_force(docs, items)
    for r in got.values():  # disjoint runs, whatever the blocks
        assert all(a["first"] + a["words"] < b["first"] for a, b in zip(r.hits, r.hits[1:]))


def test_statistics(docs):
    def stats(t):
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        found = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
        covered = {k for i in range(len(w) - 7) if found[tuple(w[i : i + 8])] > 1 for k in range(i, i + 8)}
        return len(w), sum(map(len, w)), sum(t.count(x) for x in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered)

    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    plain = docs  # its own n_words gives way
    found = decision_list.base_statistics(plain)
    assert found.columns == ["doc_id", "_id", "key", "c0", *names, "n_upper", "n_lines"]
    got = Counter(tuple(r) for r in found.select(*names).collect())
    assert got == Counter(stats(r[1]) for r in awkward())
    # A filter on the result must not change the cost of the arrays: it is answered at once.
    assert decision_list.base_statistics(plain).where("n_repeat_words > 100").count() == sum(stats(r[1])[4] > 100 for r in awkward())


def test_decision_list(spark, tiny):
    grow = [((0, 5), 0, 40), ((3, 5), 30, 1), ((3, 0), 0, 30), ((1, 9), 0, 20)]
    rules = decision_list.learn_rules(grow, grow, ["a", "b"], {"a": [0.5, 1.5, 2.5], "b": [float(x) for x in range(9)]})
    assert [str(r) for r in rules] == ["a > 1.5 and b > 0"]
    assert decision_list.learn_rules([], [], ["a"], {"a": []}) == []
    labels = spark.createDataFrame([], "doc_id long, quality int")
    assert decision_list.fit_rules(spark.read.parquet(f"{tiny}/documents.parquet"), labels) == []
    plan = decision_list.op2_quality_rules(spark, tiny)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def test_pieces_and_sequences(spark, docs, tiny):
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    model = packing.Tokenizer(path)._model
    want = Counter()
    for r in awkward():
        ids = [*model.encode(r[1] or "", add_special_tokens=False).ids, 0]
        first = len(ids) % 64 or 64
        at, piece = 0, 0
        while at < len(ids):
            size = first if at == 0 else 64
            want[r[0], piece, at, size, zlib.crc32(np.array(ids[at : at + size], dtype="<u4").tobytes())] += 1
            at, piece = at + size, piece + 1
    got = packing.pack(docs, path, capacity=64).collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    bins: dict[int, list] = {}
    for r in got:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in bins.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= 64
    assert len(bins) <= -(-sum(r.length for r in got) // 64) + 1


def test_plans_keep_every_piece():
    rng = random.Random(2)
    for k in range(60):
        counts = {rng.randint(1, 2048): rng.randint(1, rng.choice([1, 5, 1000])) for _ in range(rng.randint(0, 60 if k < 50 else 1500))}
        plan = packing.plan_bins(counts, 2048)
        placed = Counter()
        for lengths, bins in plan:
            assert sum(lengths) <= 2048 and bins > 0
            for n in lengths:
                placed[n] += bins
        assert placed == Counter(counts)


def test_tokenizer_is_the_files():
    import public_tokenizers

    t = packing.Tokenizer(public_tokenizers.path("byte_bpe_50k.json"))
    rng = random.Random(3)
    parts = [" ", "  ", "\n", "\t", "a", "B", "é", "1", "23", "'s", "'", "!", ".", "日", "<|endoftext|>", " ", "　", "x y", " z", "\x00", "\x85"]
    for _ in range(3000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 14)))
        assert np.frombuffer(t.encode(text), "<u4").tolist() == t._model.encode(text, add_special_tokens=False).ids


def test_added_tokens_are_the_files():
    import public_tokenizers
    from tokenizers import Tokenizer as Model

    path = public_tokenizers.path("byte_bpe_50k.json")
    fresh, t = Model.from_file(path), packing.Tokenizer(path)
    for text in ["x <|endoftext|> y", "<|endoftext|>", "a<|endoftext|><|endoftext|>\n b", "  <|endoftext|>  ", "<|endoftext", "plain words, 12 of them"]:
        assert np.frombuffer(t.encode(text), "<u4").tolist() == fresh.encode(text, add_special_tokens=False).ids
    assert 50256 in fresh.encode("x <|endoftext|> y", add_special_tokens=False).ids


def test_empty_tables(spark, nothing):
    import public_tokenizers

    items = spark.createDataFrame([], "item_id long, text string")
    assert suffix_dedup.cut_repeats(nothing).count() == 0
    assert bag_minhash.near_duplicates(nothing).count() == 0
    assert decontaminate.match_items(nothing.select("doc_id", "text"), items).count() == 0
    assert packing.pack(nothing, public_tokenizers.path("byte_bpe_50k.json")).count() == 0
    assert decision_list.base_statistics(nothing).count() == 0


def test_pipeline_stages_by_brute_force(spark, tmp_path):
    """Near-duplicates, repeated passages and benchmark passages one after another, on the rows the stage before kept."""
    import corpus_pipeline

    rng = random.Random(9)
    word = lambda: "".join(rng.choices("abcdefghij", k=6))
    item = " ".join(word() for _ in range(30))
    passage, base = " ".join(word() for _ in range(60)), [word() for _ in range(200)]
    own = lambda n: " ".join(word() for _ in range(n))
    texts = [own(80) for _ in range(6)] + [" ".join(base), " ".join(base[1:]), " ".join(base[:-2])]
    texts += [own(90) + " " + passage + " " + own(90), own(90) + " " + passage, own(200) + " " + item[: len(item) // 2] + " " + own(30), own(5) + " " + item, None, "", "!!"]
    rows = [(k if k != 7 else None, t, "en", "s", 0 if t is None else len(t), k) for k, t in enumerate(texts)]
    rows += [rows[0], (0, own(40), None, None, 5, None)]
    schema = "doc_id long, text string, lang string, source string, n_chars long, _h long"
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, item), (2, None)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs, stages = spark.read.parquet(f"{tmp_path}/documents.parquet"), dict(corpus_pipeline.STAGES)

    def run(name, docs):
        path = str(tmp_path / name.replace(" ", "-"))
        stages[name](spark, docs, str(tmp_path)).write.parquet(path)
        out = spark.read.parquet(path)
        return out, sorted(map(tuple, out.collect()), key=repr)

    docs, kept = run("toxicity", docs)
    assert kept == sorted(rows, key=repr)

    classes, want = classes_by_brute_force([r[1] for r in kept]), []
    for c in set(classes):
        own_rows = [r for r, x in zip(kept, classes, strict=True) if x == c]
        worded = re.search(r"[^\x20\x09-\x0D]", own_rows[0][1] or "")
        want += sorted(own_rows, key=lambda r: (r[0] is None, r[0] or 0))[:1] if worded else own_rows
    docs, kept = run("minhash near-dedup", docs)
    # Of a class the least id stays; of near-copies under one id any of them.
    assert sorted((r[0] is None, r[0] or 0) for r in kept) == sorted((r[0] is None, r[0] or 0) for r in want) and len(kept) == len(want)

    cut, want = repeats_by_brute_force([(r[1] or "").encode() for r in kept], 200), []
    for r, (_, removed, _, digest) in zip(kept, cut, strict=True):
        want.append((r[0], removed, digest))
    assert sum(x[1] > 0 for x in want) >= 2
    docs, after = run("suffix-array dedup", docs)
    assert sorted((r[0], hashlib.sha256(r[1].encode()).hexdigest(), r[4]) for r in after) == sorted((i, d, len((k[1] or "").encode()) - n) for (i, n, d), k in zip(want, kept, strict=True))

    hits = items_by_brute_force([r[1] for r in after], [(1, item), (2, None)])
    want = {r[0]: n - hit for r, (n, hit, _) in zip(after, hits, strict=True) if hit <= 0.5 * n}
    docs, last = run("benchmark decontamination", docs)
    assert {r[0]: len(decontaminate.item_words(r[1])) for r in last} == want and len(want) < len(after)
    assert not any(hit for _, hit, _ in items_by_brute_force([r[1] for r in last], [(1, item)]))

    pieces = corpus_pipeline.pack_sequences(spark, docs, str(tmp_path)).collect()
    assert Counter(r.doc_id for r in pieces if r.piece == 0) == Counter(r[0] for r in last)
    ends: dict[int, int] = {}
    for r in sorted(pieces, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == ends.get(r.sequence_id, 0)
        ends[r.sequence_id] = r.offset + r.length
    assert max(ends.values()) <= 2048
