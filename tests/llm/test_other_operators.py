"""Toxicity, language, archives, tool calls, page text and the pipeline."""

import base64
import glob
import gzip
import hashlib
import html
import json
import re
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from adloom.llm import html_text, language, tool_calls, toxicity, warc
from adloom.session import scratch_dir

SMALL = "/root/testdata/sf0.01"


def test_cumulative_link_recovers_grades():
    rng = np.random.default_rng(1)
    n, k = 3000, 30
    x = rng.poisson(0.7, (n, k)).astype(float)
    w = np.zeros(k)
    w[:4] = [2.0, 1.5, 1.0, -1.5]
    grade = np.digitize(x @ w + rng.logistic(size=n) * 0.5, [1.5, 4.0])
    row, place = np.nonzero(x)
    weights, thresholds = toxicity.fit_cumulative(row, place, x[row, place], grade, k, 3)
    assert np.all(np.diff(thresholds) > 0)
    above = (x @ weights)[:, None] > thresholds[None, :]
    assert (above.sum(axis=1) == grade).mean() > 0.75
    assert np.abs(weights[4:]).max() < 0.5 * np.abs(weights[:4]).min()


def test_toxicity_held_out(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.fit(docs, labels.where("doc_id % 3 <> 0"), refine=2)
    assert len(model.thresholds) == 2
    held = toxicity.score(docs.select("doc_id", "text"), model).join(labels.where("doc_id % 3 = 0"), "doc_id")
    got = {(r.toxic, r.rejected): r.n for r in held.groupBy("toxic", (F.col("p_above")[0] >= 0.5).alias("rejected")).agg(F.count("*").alias("n")).collect()}
    assert got[1, True] / (got[1, True] + got.get((1, False), 0)) > 0.8
    assert got.get((0, True), 0) / (got[0, False] + got.get((0, True), 0)) < 0.01


def test_toxicity_awkward(spark):
    docs = spark.createDataFrame([(1, None, "p"), (2, "", "p"), (None, "x " * 5000, "p"), (2, "", "p")], "doc_id long, text string, severity string")
    labels = spark.createDataFrame([(1, 0), (None, 1), (2, None)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    assert len(model.features) == 0
    assert [round(r.p_above[0], 3) for r in toxicity.score(docs, model).collect()] == [0.0] * 4
    none = spark.createDataFrame([], docs.schema)
    assert toxicity.score(none, toxicity.fit(none, labels)).count() == 0


def test_language_held_out(spark):
    found = language.op6_language(spark, SMALL).join(spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "lang"), "doc_id").where("held_out")
    right, n = found.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert n > 150 and right > 0.95


def test_language_learns_from_long_texts(spark):
    """Only long texts of one language, and a language named by mistake in every row."""
    long_es = " ".join(["el perro y la casa de los niños que comen pan en la calle"] * 450)
    rows = [(k, long_es + f" {k}", "es") for k in range(5)] + [(10 + k, "the dog and the house of the children", "en") for k in range(5)]
    rows += [(100 + k, "zzz qqq", f"junk{k}") for k in range(language.LANGUAGES + 50)]
    found = language.learn(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert len(found) == language.LANGUAGES and {"es", "en"} <= set(found)
    assert 5000 < len(found["es"]) <= language.DICTIONARY_BYTES
    asked = spark.createDataFrame([(1, "la casa de los niños"), (2, "the house of the dog")], "doc_id long, text string")
    assert [r.lang_pred for r in language.identify(asked, {k: found[k] for k in ("es", "en")}).collect()] == ["es", "en"]
    # All sampled texts have a share of the dictionary.
    texts = [bytes([97 + k]) * 30_000 for k in range(10)]
    assert set(language._shared(texts)) == {*range(97, 107), 32} and len(language._shared(texts)) <= language.DICTIONARY_BYTES
    assert language._shared([b"ab", b"c" * 300_000]).startswith(b"ab ccc")


def test_language_awkward(spark):
    train = spark.createDataFrame([(k, ("the cat and the dog " if k % 2 else "der hund und die katze ") * 9, "en" if k % 2 else "de") for k in range(8)]
                                  + [(90, None, "en"), (91, "x", None), (92, "123", "zz")], "doc_id long, text string, lang string")
    dictionaries = language.learn(train)
    assert list(dictionaries) == ["de", "en"]
    rows = [(1, None, "a"), (2, "", "a"), (3, "12 !", "a"), (4, "the dog and the cat", "a"), (4, "die katze und der hund", "b"), (None, "der hund " * 5000, "c")]
    got = [(r.lang_pred, 0 <= r.score <= 1) for r in language.identify(spark.createDataFrame(rows, "doc_id long, text string, score string").withColumnRenamed("score", "c0"), dictionaries).collect()]
    assert got == [("und", True)] * 3 + [("en", True), ("de", True), ("de", True)]
    assert language.identify(train.select("text"), {}).where("lang_pred <> 'und'").count() == 0


def test_archive_round_trip(spark):
    odd = "x\r\n\r\nWARC/1.1\r\n\r\n"
    pages = spark.createDataFrame([(1, "http://a/é b", odd), (2, None, None), (None, "u", ""), (3, "u", odd), (4, "q", "日本\n\r\n"), (4, "q", "日本\n\r\n"), (5, "z", "y" * 300_000)],
                                  "page_id long, url string, html string")
    path = scratch_dir(spark, "warc-test")
    warc.write_archive(pages, path)
    got = warc.captures(warc.read_records(spark, path)).collect()
    page = lambda record: record and re.fullmatch("<urn:page:([0-9]*):[A-Z2-7]{32}:[0-9]+>", record)[1]
    assert sorted((page(r.record_id), r.type, page(r.refers_to) or "", r.payload_bytes) for r in got) == sorted([
        ("1", "response", "", 17), ("2", "response", "", 0), ("", "revisit", "2", 0),
        ("3", "revisit", "1", 17), ("4", "response", "", 9), ("4", "response", "", 9), ("5", "response", "", 300_000)])
    assert len({r.record_id for r in got}) == len(got)  # repeated rows too
    assert {r.refers_to for r in got} - {None} <= {r.record_id for r in got if r.type == "response"}
    assert {bytes(r.payload) for r in got if r.type == "response"} == {odd.encode(), b"", "日本\n\r\n".encode(), b"y" * 300_000}
    assert all(r.request.record_id.endswith(":request>") and r.metadata.record_id.endswith(":metadata>") for r in got)
    empty = scratch_dir(spark, "warc-empty")
    warc.write_archive(pages.limit(0), empty)
    assert warc.captures(warc.read_records(spark, empty)).count() == 0


def test_captures_of_one_page_keep_their_own_payloads(spark):
    rows = [(1, "a", "abcd"), (2, "b", "xy"), (7, "c", "abcd"), (7, "c", "xy"), (None, "d", "xy"), (None, "d", "abcd"), (None, "d", "abcd")]
    path = scratch_dir(spark, "warc-test")
    warc.write_archive(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3), path)
    got = warc.captures(warc.read_records(spark, path)).select(
        warc._page_of("record_id", "long").alias("page"), "type", warc._page_of("refers_to", "long").alias("to"), "payload_bytes", F.size("requests").alias("n"),
        F.size("metadata_records").alias("m"))
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(
        [(1, "response", None, 4, 1, 1), (2, "response", None, 2, 1, 1), (7, "revisit", 1, 4, 1, 1), (7, "revisit", 2, 2, 1, 1),
         (None, "revisit", 2, 2, 1, 1), (None, "revisit", 1, 4, 1, 1), (None, "revisit", 1, 4, 1, 1)], key=repr)


def test_archive_of_a_member_per_record(spark, tmp_path):
    def record(kind, name, block, to=None):
        head = f"WARC/1.0\r\nWARC-Type: {kind}\r\nWARC-Record-ID: <{name}>\r\n" + (f"WARC-Concurrent-To: <{to}>\r\n" if to else "")
        return f"{head}Content-Length: {len(block)}\r\n\r\n".encode() + block + b"\r\n\r\n"

    large = np.random.default_rng(0).bytes(200_000)
    records = [record("warcinfo", "i", b"software: x\r\n")]
    for k in range(300):
        records += [record("response", f"r{k}", b"HTTP/1.1 200 OK\r\n\r\n" + (large if k == 7 else b"page %d" % k)), record("request", f"q{k}", b"GET / HTTP/1.1\r\n\r\n", f"r{k}"),
                    record("metadata", f"m{k}", b"a: 1\r\n", f"r{k}"), record("metadata", f"n{k}", b"b: 1\r\n", f"r{k}")]
    (tmp_path / "a.warc.gz").write_bytes(b"".join(map(gzip.compress, records)))
    found = warc.read_records(spark, f"file://{tmp_path}")
    assert found.count() == len(records)
    got = {r.record_id: r for r in warc.captures(found).collect()}
    assert {n: bytes(r.payload) for n, r in got.items()} == {f"<r{k}>": large if k == 7 else b"page %d" % k for k in range(300)}
    assert all([m.record_id for m in got[f"<r{k}>"].metadata_records] == [f"<m{k}>", f"<n{k}>"] and len(got[f"<r{k}>"].requests) == 1 for k in range(300))
    (tmp_path / "a.warc.gz").write_bytes(b"".join(map(gzip.compress, records))[:-9])
    with pytest.raises(Exception, match="cut short"):
        warc.read_records(spark, f"file://{tmp_path}").count()


def test_archive_files_are_bounded_by_bytes(spark, tmp_path):
    pages = spark.createDataFrame([(i, "u", f"{i}" + "y" * 20_000_000) for i in range(6)], "page_id long, url string, html string").coalesce(1)
    warc.write_archive(pages, f"file://{tmp_path}/w")
    sizes = [len(gzip.open(f).read()) for f in glob.glob(f"{tmp_path}/w/**/*.gz", recursive=True)]
    assert len(sizes) > 1 and max(sizes) < warc.FILE_BYTES + 21_000_000
    assert warc.captures(warc.read_records(spark, f"file://{tmp_path}/w", with_payload=False)).count() == 6


def test_archive_query(spark):
    pages = spark.read.parquet(f"{SMALL}/pages.parquet").collect()
    first: dict[str, int] = {}
    for r in pages:
        first[r.html or ""] = min(first.get(r.html or "", r.page_id), r.page_id)
    want = {}
    for r in pages:
        data, lead = (r.html or "").encode(), first[r.html or ""]
        want[r.page_id] = (len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "response" if lead == r.page_id else "revisit", None if lead == r.page_id else lead)
    assert {r.page_id: tuple(r)[1:] for r in warc.op5_warc(spark, SMALL).collect()} == want


def test_tool_calls_order_and_validate(spark):
    calls = spark.createDataFrame(
        [(1, "a", 5, "f", '{"n": 2, "b": [1]}', ["b", "c"]), (1, "b", 4, "f", '{"n": 1}', ["c"]), (1, "c", 9, "f", '{"n": "x"}', []),
         (1, "d", 1, "g", "{}", ["zz"]), (1, "e", 2, "f", "{oops", ["e2"]), (1, "e2", 3, "f", None, ["e"]), (2, "a", 0, "f", '{"n": 9, "q": 1}', []),
         (None, "a", 0, "f", '{"n": 1}', ["a"]), (2, None, 1, "f", '{"n": 1}', [])],
        "conv long, call string, pos long, name string, arguments string, deps array<string>")
    results = spark.createDataFrame([(1, "a", 7, "late"), (1, "a", 6, "ré"), (3, "x", 0, "lost"), (2, "a", 1, None)], "conv long, call string, pos long, content string")
    schema = {"f": {"required": ["n"], "properties": {"n": {"type": "integer", "maximum": 5}}, "additionalProperties": True}}
    rows = {(r.conv, r.call): r for r in tool_calls.link(calls, results, schema).collect()}
    order = [c for _, c in sorted((r.order, r.call) for (v, c), r in rows.items() if v == 1)]
    assert order == ["d", "c", "b", "a", "e", "e2"]
    assert [rows[1, c].level for c in "abcd"] == [2, 1, 0, 0] and rows[1, "e"].level is None
    assert rows[1, "a"].errors == [] and rows[1, "a"].n_results == 2
    assert rows[1, "a"].message == '{"arguments":{"b":[1],"n":2},"id":"a","name":"f","result":"ré"}'
    assert rows[1, "c"].errors == ["$.n: not integer"]
    assert rows[1, "d"].errors == ["unknown tool", "unknown dependency zz"]
    assert rows[1, "e"].errors == rows[1, "e2"].errors == ["$: not JSON"]
    assert rows[2, "a"].errors == ["$.n: above maximum"]
    assert rows[3, "x"].orphan and len(rows) == 10
    none = tool_calls.link(calls.limit(0), results.limit(0), schema)
    assert none.count() == 0


@pytest.mark.parametrize("text, schema, errors, written", [
    ('{"q":NaN}', {}, ["$: not JSON"], None), ('{"q":1e999}', {}, ["$: not JSON"], None), ('{"q":"\\ud800"}', {}, ["$: half a surrogate pair"], None),
    ("[" * 200_000, {}, ["$: nested too deeply"], None), ('{"\\udc00":1}', {}, ["$: half a surrogate pair"], None),
    ('{"q":true}', {"properties": {"q": {"enum": [1]}}}, ["$.q: not allowed"], '{"q":true}'), ('{"q":1.0}', {"properties": {"q": {"enum": [1]}}}, [], '{"q":1}'),
    ('{"q":1.0}', {"properties": {"q": {"type": "integer"}}}, [], '{"q":1}'), ('{"q":1.5}', {"properties": {"q": {"type": "integer"}}}, ["$.q: not integer"], '{"q":1.5}'),
    ('{"q":null}', {"properties": {"q": {"type": ["string", "null"]}}}, [], '{"q":null}'),
    ('{"q":1}', {"properties": {"q": {"type": ["string", "null"]}}}, ["$.q: not string or null"], '{"q":1}'),
    ('{"q":1e300,"a":[-0.0]}', {}, [], '{"a":[0],"q":1e+300}')])
def test_awkward_arguments(spark, text, schema, errors, written):
    value, why = tool_calls.parsed(text)
    assert ([why] if why else tool_calls.schema_errors(value, {"type": "object"} | schema)) == errors
    assert why or tool_calls.canonical(value) == written


def test_tool_calls_with_odd_arguments_and_columns(spark):
    texts = ['{"q":"\\ud800"}', "[" * 200_000, '{"q":NaN}', None, "", '{"é":1.0}']
    calls = spark.createDataFrame([(1, f"c{k}", k, "f", x, [], 1, "x", 2) for k, x in enumerate(texts)],
                                  "conv long, call string, pos long, name string, arguments string, deps array<string>, level int, order string, n_results int")
    results = spark.createDataFrame([(1, "c5", 9, "\ud7ff\U0001f642", 3)], "conv long, call string, pos long, content string, level int")
    got = {r.call: r for r in tool_calls.link(calls, results, {"f": {}}).collect()}
    assert [got[f"c{k}"].errors for k in range(6)] == [["$: half a surrogate pair"], ["$: nested too deeply"], ["$: not JSON"], ["$: not JSON"], ["$: not JSON"], []]
    assert json.loads(got["c0"].message)["arguments"] == texts[0] and json.loads(got["c3"].message)["arguments"] is None
    assert got["c5"].message == '{"arguments":{"é":1},"id":"c5","name":"f","result":"\ud7ff\U0001f642"}' and got["c5"].level == 0


def _edges(seed, n):
    """A chain of calls, a cycle with what builds on it, and random links back."""
    rng = np.random.default_rng(seed)
    deps = {f"a{k}": [f"a{k - 1}"] if k else [] for k in range(n)}
    deps |= {"x": ["z"], "y": ["x"], "z": ["y"], "w": ["x", "a0"], "lost": ["nowhere"], "self": ["self"]}
    deps |= {f"r{k}": [f"r{j}" for j in set(rng.integers(0, k, 3).tolist())] if k else [] for k in range(40)}
    return deps


def test_levels_of_long_chains_and_cycles(spark):
    deps = _edges(1, 1000)
    calls = spark.createDataFrame([(v, c, d) for v in (1, 2) for c, d in deps.items()], "conv long, call string, deps array<string>").repartition(5)
    found = {(r.conv, r.call): r.level for r in tool_calls.levels(calls, scratch_dir(spark, "levels")).collect()}
    want = {f"a{k}": k for k in range(1000)} | {"lost": 0}
    for k in range(40):
        want[f"r{k}"] = max((want[d] + 1 for d in deps[f"r{k}"]), default=0)
    assert found == {(v, c): k for v in (1, 2) for c, k in want.items()}
    # Long conversations are ordered by joins, with the same levels.
    few = {c: d for c, d in deps.items() if not c.startswith("a") or int(c[1:]) < 6}
    calls = spark.createDataFrame([(v, c, d) for v in (1, 2) for c, d in few.items() if v == 1 or c < "r2"], "conv long, call string, deps array<string>")
    one, many = ({(r.conv, r.call): r.level for r in tool_calls.levels(calls, scratch_dir(spark, "levels"), most).collect()} for most in (10_000, 40))
    assert one == many and len(one) > 50


def test_tool_call_query_by_brute_force(spark):
    turns = {}
    for r in spark.read.parquet(f"{SMALL}/conversations.parquet").collect():
        turns.setdefault(r.conv_id, {})[r.turn] = (r.role, r.text)
    want = {}
    for conv, found in turns.items():
        level = {}
        for t in sorted(found):
            if found[t][0] in ("user", "system"):
                level[t] = level[t - 2] + 1 if t - 2 in level else 0
        for k, t in enumerate(sorted(level, key=lambda t: (level[t], t))):
            role, text = found[t]
            answer = found.get(t + 1, ("user", None))
            result = answer[1] if answer[0] == "assistant" else None
            arguments = {"question": text, "turn": t} if role == "user" else {"instructions": text}
            message = json.dumps({"arguments": arguments, "id": f"call-{conv}-{t}", "name": "ask" if role == "user" else "configure", "result": result},
                                 sort_keys=True, separators=(",", ":"), ensure_ascii=False)
            want[conv, t] = (level[t], k, role != "user" or len(text) >= 40, message)
    got = {(r.conv_id, r.turn): (r.level, r.call_order, r.valid, r.message) for r in tool_calls.op9_tool_calls(spark, SMALL).where("not orphan").collect()}
    assert got == want


def test_page_text(spark):
    for r in html_text.op10_html_text(spark, SMALL).join(spark.read.parquet(f"{SMALL}/pages.parquet").select("page_id", "html"), "page_id").collect():
        inner = re.search(r"<article>(.*?)(?:</article>|$)", r.html or "", re.S)
        parts = re.split(r"</?(?:p|h1)>", inner[1] if inner else "")
        texts = [re.sub(r"\s+", " ", html.unescape(re.sub(r"<[^>]*>", "", x.replace("<br>", " ")))).strip() for x in parts]
        assert r.text == "\n\n".join(x for x in texts if x) and r.n_chars == len(r.text)


@pytest.mark.parametrize(("page", "want"), [
    ("<p>a &amp; b<br>c</p>d", ["a & b c", "d"]),
    ("<div class='x cookie-notice'>no<p>no</div>yes", ["yes"]),
    ("<article><header><h1>T</h1></header><nav>no</nav>x<section id=comments>no</section><footer>no</footer></article>", ["T", "x"]),
    ("<script>var t='</p><p>';</script>x<style>p{}", ["x"]),
    ("<!-- <p>no</p> --><ul><li>a<li>b</ul><a title='1>2'>c</a> d", ["a", "b", "c d"]),
    ("a &am b &#233; &amp", ["a &am b é &"]), ("<form>no<input>no</form>", []), ("", []), ("< 3 and <4", ["< 3 and <4"])])
def test_blocks(page, want):
    assert [b.text for b in html_text.blocks(page) if b.kind != html_text.CHROME] == want


@pytest.mark.parametrize(("page", "want"), [
    ("<html class='no-ads'><body class='has-sidebar'><nav>no</nav><main>a</main></body>", ["a"]),
    ("<body class='sidebar'><article>a</article>", ["a"]), ("<div id='page' class='menu-open'><article>a</article>b</div>", ["a", "b"]),
    ("<article class='post comments-open'>a</article>", ["a"]), ("<div class='menu'>no<main><h1>a</h1>b</main>no</div>c", ["a", "b", "c"]),
    ("<div class='widget'>no<article>a</article>no</div>", ["a"]), ("<div class='sidebar'><article>no</article></div><main>a</main>", ["a"]),
    ("<div class='comments'><article class='comment'>no</article></div>a", ["a"]), ("<aside><article>no</article></aside>a", ["a"]),
    ("<form id='aspnetForm'><input><header>no</header><article>a</article></form>", ["a"]), ("<form>no</form><form><main>a</main><form>no</form></form>", ["a"]),
    ("<form>no<script>'<article>'</script><!-- <main> --></form>a", ["a"]), ("<article><div class='entry-header'><h1>T</h1></div>x</article>", ["T", "x"]),
    ("<article><div class='header'>T</div>x<div class='comments'><article>no</article></div></article>", ["T", "x"]), ("<div data-role='menu'>a</div>", ["a"])])
def test_blocks_of_marked_wrappers(page, want):
    assert [b.text for b in html_text.blocks(page) if b.kind != html_text.CHROME] == want


def test_host_repeats(spark):
    wide = "Site wide words that are on every page of this host here"
    page = lambda i: f"<div>{wide}</div><div>{' '.join(f'w{i}.{k}' for k in range(12))}</div>"
    rows = [(i, f"http://h.x/{i}", page(i)) for i in range(3)] + [(9, None, None), (10, "http://h.x/q", ""), (11, "http://o.x/", page(0)), (12, "http://p.x", f"<article>{wide}</article>"),
                                                                 (13, "http://p.x/2", f"<article>{wide}</article>"), (14, "http://r.x", page(7)), (14, "http://r.x", page(7))]
    got = sorted((r.page_id, r.text) for r in html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect())
    unique = [" ".join(f"w{i}.{k}" for k in range(12)) for i in range(3)]
    lone = f"{wide}\n\n" + " ".join(f"w7.{k}" for k in range(12))
    assert got == [*enumerate(unique), (9, ""), (10, ""), (11, f"{wide}\n\n{unique[0]}"), (12, wide), (13, wide), (14, lone), (14, lone)]


def test_copies_and_quotes_are_no_host_repeats(spark):
    words = lambda name, n: " ".join(f"{name}.{k}" for k in range(n))
    wide, quote, long = words("wide", 12), words("quote", 10), words("long", 30)
    text = {i: f"<div>{wide}</div><div>{words(f'p{i}', 20)}</div>" for i in range(6)}
    rows = [(i, f"http://h.x/{i}", t) for i, t in text.items()] + [(10 + k, f"http://h.x/0?print={k}", text[0]) for k in range(4)]  # copies of page 0
    rows += [(20 + k, f"http://h.x/q{k}", f"<div>{words(f'q{k}', 9)} {quote} {words(f'r{k}', 9)}</div>") for k in range(3)]
    rows += [(30 + k, f"http://h.x/l{k}", f"<div>{words(f'l{k}', 9)} {long}</div>") for k in range(3)]
    rows += [(40 + k, f"http://two.x/{k}", f"<div>{words('same', 40)}</div><div>{words('part', 9) if k else ''}</div>") for k in range(2)]
    got = {r.page_id: r.text for r in html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all(got[i] == words(f"p{i}", 20) for i in range(6)) and all(got[10 + k] == words("p0", 20) for k in range(4))
    assert all(got[20 + k] == f"{words(f'q{k}', 9)} {quote} {words(f'r{k}', 9)}" for k in range(3))
    assert all(got[30 + k] == words(f"l{k}", 9) for k in range(3))
    assert got[40] == words("same", 40) and got[41] == f"{words('same', 40)}\n\n{words('part', 9)}"


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    names, counts = docs.columns, [docs.count()]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        path = scratch_dir(spark, "stage")
        stage(spark, docs, SMALL).write.parquet(path)
        before, docs = docs, spark.read.parquet(path)
        counts.append(docs.count())
        if k < 4:
            assert docs.columns == names and docs.schema["text"].dataType.simpleString() == "string"
            assert docs.where("n_chars <> length(text)").count() == 0
            lost = before.join(docs, "doc_id", "left_anti").count()
            assert lost == counts[-2] - counts[-1]
    assert counts[0] > counts[1] > counts[2] == counts[3] >= counts[4]
    assert docs.groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 2048").count() == 0


def test_pipeline_on_awkward_rows(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    rows = [(1, None, None, None, None), (2, "", "en", "s", 0), (3, "same words here again and again", "en", "s", 31), (3, "same words here again and again", "en", "s", 31),
            (None, "other words that are here for once", None, "s", 34), (4, "same words here again and again", "de", None, None)]
    spark.createDataFrame(rows, schema).write.parquet(f"file://{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"file://{tmp_path}/labels.parquet")
    spark.createDataFrame([(0, None)], "item_id long, text string").write.parquet(f"file://{tmp_path}/benchmark.parquet")
    got = corpus_pipeline.run(spark, f"file://{tmp_path}")
    assert sorted((r.doc_id is None, r.doc_id) for r in got.collect()) == [(False, 1), (False, 2), (False, 3), (True, None)]


ARTICLE = "<html><body class='has-sidebar'><article class='post comments-open'><h1>T</h1><p>Keep me.</p>{}<p>And me.</p></article></body></html>"


@pytest.mark.parametrize("token", ["share-buttons", "related-posts", "ad-slot", "sidebar-left", "post-comments", "subscribe-form", "cookiebar", "ad", "notice"])
def test_marked_parts_inside_an_article_go(token):
    found = html_text.blocks(ARTICLE.format(f"<div class='x {token}'>junk <b>more</b><p>junk</p></div>"))
    assert [b.text for b in found if b.kind == html_text.MAIN] == ["T", "Keep me.", "And me."]


def test_states_layouts_and_hidden_elements():
    kept = "<div class='menu-open has-ads'>one</div><header class='entry-header'>two</header><section id='search-content'>three</section>"
    gone = "<div hidden>x</div><p style='color:red; display : none'>x</p><i style=visibility:hidden>x</i><div HIDDEN=''>x</div>"
    found = html_text.blocks(ARTICLE.format(kept + gone + "<input value='a>b' class='hidden'>four"))
    assert [b.text for b in found if b.kind == html_text.MAIN] == ["T", "Keep me.", "one", "two", "three", "four", "And me."]


@pytest.mark.parametrize("page", ["<a " * 350_000, "<div>" * 200_000 + "</p>" * 200_000, '<a "' * 250_000, "<a x='" * 150_000 + "<p>y", "<!--" * 250_000, "<" * 500_000,
                                  "<b '\">" * 150_000, "</a " * 250_000])
def test_scanner_takes_time_in_proportion(page):
    took = []
    for part in (page[: len(page) // 4], page):
        begun = time.perf_counter()
        html_text.blocks(part)
        took.append(time.perf_counter() - begun)
    assert took[1] < 8 * took[0] + 1  # four times as long a page; sixteen times as long if it were quadratic


def test_unended_tags_and_quotes():
    assert [b.text for b in html_text.blocks("<p>a < b <a x <b y")] == ["a < b <a x <b y"]
    assert [b.text for b in html_text.blocks("<p title='it>x</p><p>y</p>")] == ["x", "y"]
    assert [b.text for b in html_text.blocks("<p title='a>b'>x<!-- c > d --!>y<script>var a='</p>';</script >z")] == ["xyz"]


def test_pages_that_repeat_id_and_url(spark):
    """What stands on many pages of a host goes, also where ids and urls are null or the same."""
    common = "This notice text stands on every page of this host and is quite long, long enough to be cut as a whole block."
    pages = [f"<div>{common}</div><div>{' '.join(f'own{k}x{i}' for i in range(30))}</div>" for k in range(8)]
    for ids in ([(k, f"http://h/{k}") for k in range(8)], [(1, "http://h/a")] * 8, [(None, "http://h/a")] * 8, [(None, None)] * 8):
        df = spark.createDataFrame([(i, u, x, "e") for (i, u), x in zip(ids, pages, strict=True)], "page_id long, url string, html string, text string").repartition(3)
        got = sorted(r.text for r in html_text.extract(df).collect())
        assert got == sorted(" ".join(f"own{k}x{i}" for i in range(30)) for k in range(8))


def test_severity_by_brute_force(spark):
    """Scores and thresholds worked out word by word in plain Python."""
    from adloom.llm import textops

    docs, labels = (spark.read.parquet(f"{SMALL}/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.fit(docs, labels, refine=2)
    known = dict(zip(model.features.tolist(), model.weights.tolist(), strict=True))

    def feature(data: bytes) -> int:
        return int(textops.SpanHashes(np.frombuffer(data, np.uint8)).of(np.array([0]), np.array([len(data)]))[0])

    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").limit(150).collect()] + [(-1, None), (-2, "12 !"), (-3, "WORD " * 3000)]
    for r in toxicity.score(spark.createDataFrame(rows, "doc_id long, text string"), model).collect():
        text = bytes(b + 32 if 65 <= b <= 90 else b for b in (r.text or "").encode())
        found: dict[int, int] = {}
        for word in re.findall(rb"[a-z\x80-\xff]+", text):
            for f in [feature(word), *(feature(word[:n]) ^ n for n in (4, 5, 6) if len(word) > n)]:
                if f in known:
                    found[f] = found.get(f, 0) + 1
        score = sum(known[f] * np.log1p(n) for f, n in found.items())
        above = [1 / (1 + np.exp(-np.clip(score - t, -35, 35))) for t in model.thresholds]
        shares = -np.diff([1, *above, 0])
        assert np.allclose(r.p_above, above) and np.isclose(r.severity, sum(above))
        assert shares[r.grade] >= shares.max() - 1e-9


def test_sample_of_repeated_ids_is_the_same_each_time(spark):
    from adloom.llm.labels import labelled_sample

    docs = spark.createDataFrame([(k % 5, f"text {k}") for k in range(50)] + [(None, "none")], "doc_id long, text string")
    grades = spark.createDataFrame([(k, k % 2) for k in range(5)] + [(1, 0), (None, 1)], "doc_id long, toxic int")
    found = [sorted(map(tuple, labelled_sample(docs.repartition(n), grades, "doc_id", "toxic", 10, [F.col("text")]).collect())) for n in (1, 7)]
    assert found[0] == found[1] == [(k, k % 2, min(f"text {j}" for j in range(k, 50, 5))) for k in range(5)]


def test_language_sizes_by_brute_force(spark):
    import zstandard

    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text", "lang").limit(300)
    dictionaries = language.learn(docs)
    assert len(dictionaries) >= 3 and all(len(d) <= language.DICTIONARY_BYTES for d in dictionaries.values())
    for r in language.identify(docs, dictionaries).limit(60).collect():
        data = re.sub(r"[\W\d_]+", " ", (r.text or "").lower()).strip().encode()
        if not data:
            assert (r.lang_pred, r.score) == ("und", 0.0)
            continue
        sizes = {}
        for lang, raw in dictionaries.items():
            prepared = zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            prepared.precompute_compress(level=language.LEVEL)
            sizes[lang] = sum(len(zstandard.ZstdCompressor(level=language.LEVEL, dict_data=prepared, write_content_size=False, write_dict_id=False).compress(data[k : k + language.BLOCK_BYTES]))
                              for k in range(0, len(data), language.BLOCK_BYTES))
        best, second = sorted(sizes.items(), key=lambda x: (x[1], x[0]))[:2]
        assert r.lang_pred == best[0] and np.isclose(r.score, 1 - best[1] / second[1]) and r.confident == (r.score >= language.LEAST_MARGIN)


def test_verdicts_by_brute_force(spark):
    from adloom.llm import decision_list

    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    rules = decision_list.fit_rules(docs, spark.read.parquet(f"{SMALL}/labels.parquet"))
    rules += [decision_list.Rule((decision_list.Condition("upper_share", True, 0.03, 0), decision_list.Condition("word_length", False, 5.0, 0)), 1, 0),
              decision_list.Rule((decision_list.Condition("dup_line_share", True, 0.2, 0),), 1, 0)]
    stats = decision_list.base_statistics(docs).withColumn("failed", decision_list.base_failed()).withColumn("rule", decision_list.verdict(rules))
    seen = set()
    for r in stats.collect():
        measures = {"n_words": r.n_words, "word_length": r.word_chars / max(1, r.n_words), "symbol_share": r.n_symbols / max(1, r.word_chars),
                    "dup_line_share": r.n_dup_lines / max(1, r.n_lines), "repeat_share": r.n_repeat_words / max(1, r.n_words), "upper_share": r.n_upper / max(1, r.word_chars)}
        first = next((k for k, rule in enumerate(rules, 1) if all((measures[c.measure] > c.threshold) == c.above for c in rule.conditions)), None)
        assert r.failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words) and r.rule == first
        seen.add(first)
    assert len(seen) >= 3
