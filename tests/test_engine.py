"""Framework, parsing, ladder, assembly, audit, runs and a whole run with a fake provider."""

import io
import json
import os
import random
import time
import zipfile

import pytest
from pyspark.sql import functions as F

from quotarium import settings as S
from quotarium import storage
from quotarium.__main__ import provider_options
from quotarium.operators import assembly, audit, framework, ladder, pacing, prompts, requests, responses, runs
from quotarium.plans import derived, engine
from quotarium.settings import Settings
from quotarium.sources import documents, tables, wire
from quotarium.sources.providers import FakeProvider, HttpBatchProvider, LandedProvider, ProviderError, SynchronousProvider, get_provider, retry_after
from quotarium.sources.xlsx import read_sheet, write_sheet

HEAD = derived.COLUMNS
PAGE1 = "The pilot\u2019s e\ufb03ciency rose \u2014 as the team had hoped \u2014 within one year.\nA second measure\u00ad ment of inno-\nvation followed in the spring of the same year, and costs fell by"
PAGE2 = "one third. Nobody had expected that the harbour would close so early in winter. The end came in March."


def docs(spark, rows):
    return assembly.from_blocks(spark.createDataFrame(rows, assembly.BLOCKS))


@pytest.fixture(scope="module")
def corpus(spark):
    rows = [("a.pdf", 1, 0, PAGE1, 100.0, 200.0, 792.0), ("a.pdf", 2, 0, PAGE2, 100.0, 200.0, 792.0), ("scan.pdf", 1, 0, "x", 100.0, 200.0, 792.0)]
    return docs(spark, rows).persist()


def verdict(spark, corpus, snippet, filename="a.pdf", **more):
    rows = spark.createDataFrame([("s", "h", filename, snippet)], "snippet_id string, finding_hash string, filename string, snippet string")
    return ladder.verify(rows, corpus, Settings(**more)).first()


LONG = "nobody had expected that the harbour would close so early in winter"


@pytest.mark.parametrize(
    "snippet, status, page",
    [
        ("the pilot's efficiency rose - as the team had hoped", S.VERIFIED, 1), ("measurement of innovation followed", S.NEAR, 1), ("of innovation followed", S.VERIFIED, 1), ("costs fell by one third", S.VERIFIED, 1),
        ("The pilot's ... followed in the spring", S.FRAGMENTED, 1), ("in March [...] Nobody had expected", S.FRAGMENTED, 2), ("The pilot's ... zq", S.FRAGMENTED, 1), ("the end came in march", S.VERIFIED, 2),
        ("nineteen lighthouses never agreed on the colour of the bell", S.NOT_FOUND, None), ("", S.NOT_FOUND, None), ("  \u200b ", S.NOT_FOUND, None), ("ab ... cd", S.NOT_FOUND, None),
        (LONG.replace("winter", "wintor"), S.FUZZY, 2), (LONG.replace("early", "sooner"), S.NEAR, 2), ("end came im March.", S.NEAR, 2),
    ],
)
def test_ladder(spark, corpus, snippet, status, page):
    r = verdict(spark, corpus, snippet)
    assert (r["verification_status"], r["page_number"]) == (status, page)
    assert r["match_method"] == {S.VERIFIED: "exact", S.FRAGMENTED: "fragmented", S.FUZZY: "fuzzy", S.NEAR: "fuzzy", S.NOT_FOUND: "none"}[status]
    assert (r["matched_text"] != "") == (status in (S.FUZZY, S.NEAR))


def test_ladder_states(spark, corpus):
    assert verdict(spark, corpus, "anything", "scan.pdf")["verification_status"] == S.NO_TEXT_LAYER
    assert verdict(spark, corpus, "anything", "gone.pdf")["verification_status"] == S.MISSING
    assert verdict(spark, corpus, "anything", "")["verification_status"] == S.MISSING
    near = LONG.replace("early", "sooner")
    assert verdict(spark, corpus, near, fuzzy_threshold=90.0)["verification_status"] == S.FUZZY
    assert 0 < verdict(spark, corpus, "nineteen lighthouses never agreed")["match_score"] < 93


def test_matched_text_with_longer_folding(spark):
    text = "Die Stra\u00dfe ist gro\u00df und die F\u00fc\u00dfe sind m\u00fcde, doch niemand bleibt auf der Stra\u00dfe stehen."
    d = docs(spark, [("g.pdf", 1, 0, text, 100.0, 200.0, 792.0)])
    quote = "doch niemand blelbt auf der stra\u00dfe stehen."
    assert verdict(spark, d, quote, "g.pdf", compat_matched_text=False)["matched_text"] == "doch niemand bleibt auf der Stra\u00dfe stehen."
    assert verdict(spark, d, quote, "g.pdf")["matched_text"] != "doch niemand bleibt auf der Stra\u00dfe stehen."


def test_boilerplate(spark):
    body = "The same body text stands on every page and must never be taken for a header."
    rows = [("j.pdf", p, k, t, y0, y1, 792.0) for p in range(1, 5) for k, (t, y0, y1) in enumerate([(f"Journal of Things {p}", 18.0, 32.0), (body, 300.0, 340.0), (f"only here {'abcd'[p - 1]}", 750.0, 760.0)])]
    rows += [("one.pdf", 1, 0, "Journal 1", 18.0, 32.0, 792.0), ("blank.pdf", 1, 0, "Head", 18.0, 32.0, 792.0), ("blank.pdf", 2, 0, None, 0.0, 0.0, 792.0), ("blank.pdf", 3, 0, "Head", 18.0, 32.0, 792.0)]
    b = spark.createDataFrame(rows, assembly.BLOCKS)
    assert {(r["filename"], r["sig"]) for r in assembly.boilerplate(b).collect()} == {("j.pdf", "journal of things #"), ("blank.pdf", "head")}
    got = {r["filename"]: r for r in assembly.from_blocks(b).collect()}
    assert "journal" not in got["j.pdf"]["full_cf"] and got["j.pdf"]["full_cf"].count("body") == 4 and "only here c" in got["j.pdf"]["full_cf"]
    assert got["one.pdf"]["full_cf"] == "journal 1" and got["blank.pdf"]["full_cf"] == "  " and got["blank.pdf"]["page_offsets"] == [0, 1, 2]
    kept = {r["filename"]: r["full_cf"] for r in assembly.from_blocks(b, Settings(strip_boilerplate=False)).collect()}
    assert kept["j.pdf"].startswith("journal of things 1")
    # a quote over a page break is found only without the header
    split = [("s.pdf", p, k, t, y, y + 10, 792.0) for p, half in ((1, "the sentence that begins here and goes on"), (2, "and on over the break until it ends at last")) for k, (t, y) in enumerate([("Running Head 12", 20.0), (half, 300.0)])]
    s = spark.createDataFrame(split, assembly.BLOCKS)
    quote = "begins here and goes on and on over the break"
    assert verdict(spark, assembly.from_blocks(s), quote, "s.pdf")["verification_status"] == S.VERIFIED
    assert verdict(spark, assembly.from_blocks(s, Settings(strip_boilerplate=False)), quote, "s.pdf")["verification_status"] != S.VERIFIED


def test_empty_tables(spark):
    none = docs(spark, [])
    assert none.count() == 0
    f = spark.createDataFrame([], "snippet_id string, finding_hash string, filename string, snippet string")
    assert ladder.verify(f, none).count() == 0
    assert audit.verified_ratio(ladder.verify(f, none)).first()["ratio"] is None


def test_framework(spark):
    labels = derived.labels(spark)
    assert [r["category"] for r in framework.categories(labels).orderBy("cat_ord").collect()] == ["Outcomes", "Methods", "Barriers"]
    block = framework.prompt_blocks(labels).filter("category = 'Barriers'").first()["blocks"]
    assert block.count("Exclude:") == 1 and block.index("COST") < block.index("BAR_LAW")
    with pytest.raises(framework.FrameworkError, match="missing columns"):
        framework.from_rows(spark, ["Category", "Code"], [])
    with pytest.raises(framework.FrameworkError, match="code in row 3"):
        framework.validated(framework.from_rows(spark, HEAD, [["a", "b", "c", "d", ""], ["a", " ", "c", "d", None]]))
    with pytest.raises(framework.FrameworkError, match="Barriers / COST"):
        framework.validated(framework.from_rows(spark, HEAD, [list(r) for r in derived.DEFECTS]))
    p = prompts.analysis_prompts(labels).filter("category = 'Methods'").first()["prompt"]
    assert "MET_TRIAL" in p and "OUT_GAIN" not in p and "confidence" in p
    assert "confidence" not in prompts.analysis_prompts(labels, False).first()["prompt"]
    assert "COST, BAR_LAW" in prompts.summary_prompts(labels).filter("category = 'Barriers'").first()["prompt"]


def answer(*items):
    return json.dumps({"findings": list(items)})


GOOD = {"label_code": "COST", "snippet": " costs fell ", "reasoning": "r", "confidence": " HIGH "}


def test_parsing(spark):
    bad = [answer(GOOD) + " x", "", "{}", '{"findings": "x"}', "[]", answer(GOOD, 1, GOOD), answer({"label_code": " ", "snippet": "s"}), answer({"label_code": None, "snippet": "s"}), answer(GOOD | {"label_code": "MET_TRIAL"}), '{"findings": [{"label_code": "COST", "label_code": "BAR_LAW", "snippet": "s", "x": NaN}]}']
    rows = [("Barriers", i, "f.pdf", True, t, None) for i, t in enumerate(bad)] + [("Barriers", 90, "f.pdf", False, None, "down"), ("Barriers", 91, "f.pdf", False, None, None), ("Nowhere", 92, "f.pdf", True, answer(GOOD), None)]
    df = spark.createDataFrame(rows, "category string, response_ord long, filename string, success boolean, text string, error_message string")
    answers = responses.decoded(df, derived.labels(spark))
    errs = {(r["finding_ord"]["response_ord"], r["finding_ord"]["pos"]): r for r in responses.errors(answers, "t").collect()}
    assert {k: r["error_type"] for k, r in errs.items()} == {(0, -1): "json_parse_failed", (1, -1): "no_text", (3, -1): "invalid_structure", (4, -1): "invalid_structure", (5, 1): "invalid_finding_item", (6, 0): "missing_fields", (7, 0): "hallucinated_code", (8, 0): "hallucinated_code", (90, -1): "api_error", (91, -1): "api_error", (92, 0): "hallucinated_code"}
    assert errs[(5, 1)]["error_message"] == "Finding #1 is not a dict: int" and errs[(91, -1)]["error_message"] == "Unknown API error"
    assert errs[(8, 0)]["error_message"] == "Finding #0: label_code 'MET_TRIAL' is not in category 'Barriers'. Valid: ['BAR_LAW', 'COST']"
    assert errs[(0, -1)]["raw_text"] == bad[0] and errs[(7, 0)]["raw_text"] == '{"label_code": null, "snippet": "s"}'
    found = {(r["finding_ord"]["response_ord"], r["snippet_id"][-4:]): r for r in responses.findings(answers, "t").collect()}
    assert set(found) == {(5, "0001"), (5, "0002"), (9, "0001")}
    assert (found[(5, "0001")]["snippet"], found[(5, "0001")]["confidence"], found[(9, "0001")]["label_code"]) == ("costs fell", "high", "BAR_LAW")


def test_wire(spark, tmp_path):
    lines = [
        {"custom_id": "a", "result": {"type": "succeeded", "message": {"content": [{"type": "text", "text": " x"}, {"type": "tool", "text": "no"}, {"type": "text", "text": "y "}]}}},
        {"custom_id": "b", "result": {"type": "errored", "error": {"message": "bad"}}}, {"custom_id": "c", "result": {"type": "succeeded", "text": " z "}},
        {"custom_id": "d", "result": {"type": "errored", "error_message": "worse"}}, {"custom_id": "e", "result": {"type": "expired"}}, {"custom_id": "f", "result": {"type": "succeeded", "message": {"content": []}}},
    ]
    (tmp_path / "r.jsonl").write_text("\n\n".join(map(json.dumps, lines)) + "\nnot json\n")
    got = {r["custom_id"]: r for r in responses.results(wire.read_records(spark, str(tmp_path))).collect()}
    assert [(got[k]["success"], got[k]["text"], got[k]["error_message"]) for k in "abcdef"] == [(True, "x\ny", None), (False, None, "bad"), (True, " z ", None), (False, None, "worse"), (False, None, "result type: expired"), (True, None, None)]
    assert not got[""]["success"] and len(got) == 7


def test_audit_by_id(spark):
    rows = [("x", 1, S.VERIFIED, 100.0, "exact", 1, ""), ("x", 2, S.NOT_FOUND, 43.25, "none", None, ""), ("y", 3, S.NEAR, 96.65, "fuzzy", 7, "t" * 3000)]
    v = spark.createDataFrame(rows, "snippet_id string, finding_ord int, verification_status string, match_score double, match_method string, page_number long, matched_text string")
    assert [r["snippet_id"] for r in audit.clean(v).collect()] == ["y"]
    assert {(r["snippet_id"], r["page_number"]) for r in audit.with_pages(v).collect()} == {("x", None), ("y", 7)}
    got = {r["finding_ord"]: r for r in audit.audit(v).collect()}
    assert got[2]["match_score"] == round(43.25, 1) and got[3]["match_score"] == round(96.65, 1) and len(got[3]["matched_text"]) == 2000
    assert {r["verification_status"]: r["n"] for r in audit.status_summary(v).collect()} == {S.VERIFIED: 1, S.NOT_FOUND: 1, S.NEAR: 1}
    again = audit.reaudit(spark.createDataFrame([("x", "keep"), ("z", "alone")], "snippet_id string, extra string"), v)
    assert {(r["snippet_id"], r["extra"], r["verification_status"]) for r in again.collect()} == {("x", "keep", S.NOT_FOUND), ("z", "alone", None)}


def test_requests(spark):
    files = requests.numbered(spark.createDataFrame([(f"f{i:03d}.pdf", f"id{i}") for i in range(200)][::-1], "filename string, file_id string"), 7)
    assert [r["idx"] for r in files.orderBy("filename").collect()] == list(range(1, 201))
    matrix = requests.request_matrix(files, prompts.analysis_prompts(derived.labels(spark)))
    assert matrix.count() == 600
    body = json.loads(requests.batch_bodies(matrix.filter("idx = 3 and category = 'Methods'"), 'm"x', 9).first()["body"])
    assert body["custom_id"] == "req-0003-f002_pdf" and body["params"]["model"] == 'm"x' and body["params"]["messages"][0]["content"][0] == {"type": "document", "source": {"type": "file", "file_id": "id2"}}
    assert [requests.rate(*a) for a in (("Batch", "x-Opus-1"), ("batch", "sonnet"), ("batch", "?"), ("synchronous", "opus"), ("new", ""))] == [0.06, 0.01, 0.005, 0.02, 0.005]


def test_pacing(spark):
    s = Settings(tokens_per_minute=100, safety_margin=0.5, window_seconds=60)
    rows = [("l", i, ts * 1_000_000, n) for i, (ts, n) in enumerate([(0, 30), (10, 30), (60, 20), (61, 90), (200, 5), (200, 6)])]
    log = spark.createDataFrame(rows, "lane string, seq long, ts_us long, tokens long")
    got = {r["seq"]: r for r in pacing.window_usage(log, s).collect()}
    assert [got[i]["used"] for i in range(6)] == [0, 30, 60, 50, 0, 5]
    assert [got[i]["estimate"] for i in range(6)] == [1, 30, 30, 26, 42, 35]
    assert [got[i]["admitted"] for i in range(6)] == [True, False, False, False, True, True]
    sent = [r["sent_us"] for r in pacing.replay(log, s).orderBy("seq").collect()]
    assert sent[0] == 0 and sent[1] > 60_000_000 and sent == sorted(sent)
    pacer = pacing.TokenPacer(50)
    assert pacer.wait_us(0) == 0
    pacer.record(0, 45), pacer.record(0, 0)
    assert pacer.wait_us(60_000_000) == 1_000_000 and pacer.wait_us(60_000_001) == 0


def test_sheets(spark, tmp_path):
    rows = [("a", 1, None, "x & <y>"), ("NA", 2.5, "", "long " * 3)]
    head, body = read_sheet(write_sheet(["one", "two", "three", "four"], rows))
    assert head == ["one", "two", "three", "four"] and body == [["a", "1", None, "x & <y>"], ["NA", "2.5", "", "long " * 3]]
    path = f"{tmp_path}/fw.xlsx"
    (tmp_path / "fw.xlsx").write_bytes(write_sheet(HEAD, derived.FRAMEWORK))
    assert tables.load_framework(spark, path).count() == len(derived.FRAMEWORK)
    spark.createDataFrame(derived.FRAMEWORK, ", ".join(f"`{c}` string" for c in HEAD)).coalesce(1).write.csv(f"{tmp_path}/fw.csv", header=True)
    assert tables.load_framework(spark, f"{tmp_path}/fw.csv").count() == len(derived.FRAMEWORK)


def test_run_state(spark, tmp_path):
    path = f"{tmp_path}/state.json"
    assert runs.load(spark, path) is None
    runs.save(spark, path, runs.RunState([{"filename": "\u00fc.pdf", "file_id": "1"}], {"A": "b1"}))
    runs.save(spark, path, runs.RunState([], {"B": "b2"}))
    assert runs.load(spark, path) == runs.RunState([{"filename": "\u00fc.pdf", "file_id": "1"}], {"A": "b1", "B": "b2"})
    files, batches = runs.state_tables(spark, path)
    assert files.count() == 1 and {tuple(r) for r in batches.collect()} == {("A", "b1"), ("B", "b2")}
    assert runs.RunState.from_json('{"batches": [{"category": "A", "batch_id": "1"}, {"category": "A", "batch_id": "2"}]}').batches == {"A": "2"}


TEXTS = {"a.txt": "Costs fell by one third within a single year, the report says.\n\nNobody had expected it.\fSecond page with more words.", "b.txt": "A rule stands in the way of nearly all the builders in town, they say."}


def _answer(custom_id, prompt, file_id):
    if "Methods" in prompt or "MET_" in prompt:
        return "no json"
    quote = "costs fell by one third" if "a.txt" in file_id else "this sentence is nowhere to be found in it"
    return answer({"label_code": "COST", "snippet": quote, "reasoning": "r", "confidence": "low"})


@pytest.fixture
def folder(tmp_path):
    d = tmp_path / "docs"
    d.mkdir()
    for name, text in TEXTS.items():
        (d / name.replace(".txt", ".pdf")).write_text(text)
    (d / "notes.md").write_text("not a document")
    return str(d)


def test_whole_run(spark, folder, tmp_path):
    def fake(custom_id, prompt, file_id):
        return _answer(custom_id, prompt, file_id.replace(".pdf", ".txt"))

    labels, out, landing = derived.labels(spark), f"{tmp_path}/out", f"{tmp_path}/landing"
    blocks = documents.blocks(spark, folder, {".pdf": documents.text_blocks})
    dry = engine.run(spark, labels, folder, FakeProvider(spark, Settings(), landing, fake), out, Settings(dry_run=True))
    assert dry.requests.count() == 6 and dry.cost.first()["n_requests"] == 6 and dry.verdicts is None
    done = engine.run(spark, labels, folder, FakeProvider(spark, Settings(), landing, fake), out, run_ts="t", kind="xlsx", blocks=blocks)
    assert {(r["filename"], r["label_category"]): (r["verification_status"], r["page_number"]) for r in done.verdicts.collect()} == {("a.pdf", "Outcomes"): (S.VERIFIED, 1), ("a.pdf", "Barriers"): (S.VERIFIED, 1), ("b.pdf", "Outcomes"): (S.NOT_FOUND, None), ("b.pdf", "Barriers"): (S.NOT_FOUND, None)}
    assert {r["error_type"] for r in done.errors.collect()} == {"json_parse_failed"}
    head, rows = read_sheet((tmp_path / "out" / "coded_findings.xlsx").read_bytes())
    assert head == list(S.FINDING_COLUMNS) and len(rows) == 2
    assert len(read_sheet((tmp_path / "out" / "coded_findings_verified.xlsx").read_bytes())[1]) == 4 and len(read_sheet((tmp_path / "out" / "errors.xlsx").read_bytes())[1]) == 2
    assert (tmp_path / "out" / "prompts" / "prompt_used__Barriers.txt").exists()

    def broken(*a):
        raise AssertionError("nothing is to be submitted again")

    provider = LandedProvider(spark, Settings(), landing)
    again = engine.run(spark, labels, folder, provider, out, resume=True, run_ts="t", blocks=blocks)
    assert {tuple(r) for r in again.clean.select("snippet_id", "page_number").collect()} == {tuple(r) for r in done.clean.select("snippet_id", "page_number").collect()}
    stored = runs.load(spark, f"{out}/run_state.json")
    del stored.batches["Methods"]
    (tmp_path / "out" / "run_state.json").write_text(stored.to_json())
    with pytest.raises(ProviderError):
        engine.run(spark, labels, folder, provider, out, resume=True, blocks=blocks)
    again = engine.verify_files(spark, f"{out}/coded_findings_verified.xlsx", assembly.from_blocks(blocks), f"{tmp_path}/again.xlsx")
    assert again.filter("verification_status = 'verified'").count() == 2 and again.columns[:3] == ["snippet_id", "filename", "label_category"]


def test_discovery(spark, folder):
    assert [(r["filename"], r["idx"]) for r in documents.discover(spark, folder).collect()] == [("a.pdf", 1), ("b.pdf", 2)]
    assert documents.discover(spark, folder, 1).count() == 1 and documents.discover(spark, folder, 0).count() == 0
    with pytest.raises(Exception, match="office"):
        documents.no_office(b"")


def test_providers(spark, tmp_path):
    s = Settings(poll_deadline_seconds=0.01, poll_seconds=0.02, throttled_wait_seconds=0.01)
    with pytest.raises(ValueError):
        get_provider("nobody", spark, s, "x")
    p = get_provider(" JSONL ", spark, s, str(tmp_path))
    with pytest.raises(ProviderError, match="complete"):
        p.poll("none")
    assert [retry_after({"Retry-After": x}, 60.0) for x in ("3", "0", "soon", None)] == [3.0, 60.0, 60.0, 60.0]

    def call(custom_id, prompt, file_id, uri):
        if file_id == "bad":
            raise RuntimeError("it broke")
        return {"text": "{}", "tokens": 5}

    sync = SynchronousProvider(spark, s, str(tmp_path), call, lanes=2)
    rows = spark.createDataFrame([("c1", "p", "ok"), ("c2", "p", "bad")], "custom_id string, prompt string, file_id string")
    status = sync.check(sync.submit("A", rows))
    assert status.is_complete and status.counts == {"succeeded": 1, "errored": 1}


def test_landed_chunks_are_not_asked_again(spark, tmp_path):
    """A run that breaks in the middle has landed whole chunks; with the same key the rest alone is asked."""
    seen, s = tmp_path / "seen", Settings()
    seen.mkdir()

    def call(custom_id, prompt, file_id, uri):
        with open(seen / f"{custom_id}-{os.getpid()}-{time.time_ns()}", "w"):
            pass
        return {"text": custom_id, "tokens": 3}

    rows = spark.createDataFrame([(f"c{i}", "p", f"f{i}") for i in range(40)], "custom_id string, prompt string, file_id string")
    first = SynchronousProvider(spark, s, str(tmp_path / "landing"), call, chunk=10)
    batch = first.submit("A", rows)
    assert len(list(seen.iterdir())) == 40 and first.check(batch).counts == {"succeeded": 40, "errored": 0}
    folder = tmp_path / "landing" / batch
    assert len(list(folder.glob("chunk=*"))) == 4
    gone = (folder / "chunk=2" / "_SUCCESS")
    n = sum(len(f.read_text().splitlines()) for f in (folder / "chunk=2").glob("part-*"))
    gone.unlink(), (folder / "_SUCCESS").unlink()
    again = SynchronousProvider(spark, s, str(tmp_path / "landing"), call, chunk=10)
    again.run_key = first.run_key
    assert again.submit("A", rows) == batch and len(list(seen.iterdir())) == 40 + n
    assert {r["text"] for r in responses.results(wire.read_records(spark, str(folder))).collect()} == {f"c{i}" for i in range(40)}
    assert again.submit("B", rows.limit(0)) != batch


def test_synchronous_service(spark, tmp_path):
    """The call that ships, over a real socket, with the document's content."""
    import http.server
    import threading

    asked = []

    class Server(http.server.BaseHTTPRequestHandler):
        def do_POST(self):  # noqa: N802
            asked.append((self.path, self.headers["x-key"], json.loads(self.rfile.read(int(self.headers["content-length"])))))
            self.send_response(200)
            self.end_headers()
            self.wfile.write(json.dumps({"output": [{"content": [{"type": "output_text", "text": "{}"}, {"type": "other"}]}], "usage": {"total_tokens": 7}}).encode())

        def log_message(self, *a):
            pass

    server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Server)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    try:
        (tmp_path / "a.pdf").write_bytes(b"%PDF")
        os.environ["OWN_KEY"] = "secret"
        s = Settings(model="m", provider="synchronous")
        options = provider_options("Synchronous", s, f"http://127.0.0.1:{server.server_port}", ["x-key=env:OWN_KEY"], None, 1)
        p = get_provider("synchronous", spark, s, f"{tmp_path}/landing", **options)
        files = p.upload(documents.discover(spark, str(tmp_path)))
        rows = requests.request_matrix(files, prompts.analysis_prompts(derived.labels(spark))).filter("category = 'Methods'")
        batch = p.submit("Methods", rows)
        assert p.check(batch).counts == {"succeeded": 1, "errored": 0}
        path, key, body = asked[0]
        assert path == "/responses" and key == "secret" and body["model"] == "m"
        assert body["input"][0]["content"][1] == {"type": "input_file", "filename": "a.pdf", "file_data": "data:application/pdf;base64,JVBERg=="}
    finally:
        server.shutdown()
    with pytest.raises(SystemExit):
        provider_options("synchronous", s, None, [], None, 1)
    with pytest.raises(SystemExit):
        provider_options("batch", s, None, [], None, 1)
    assert provider_options("batch", s, "http://x", ["a=b"], None, 1) == {"base_url": "http://x", "headers": {"a": "b"}}
    assert provider_options("synchronous", s, None, [], "json:dumps", 3)["call"] is json.dumps


def test_settings_from_text(monkeypatch):
    monkeypatch.setenv("QUOTARIUM_MODEL", "m")
    monkeypatch.setenv("QUOTARIUM_MAX_DOCUMENTS", "5")
    monkeypatch.setenv("QUOTARIUM_STRIP_BOILERPLATE", "no")
    s = Settings.from_env(model="given", **Settings.parsed({"fuzzy_threshold": "98.5"}))
    assert (s.model, s.max_documents, s.strip_boilerplate, s.fuzzy_threshold) == ("given", 5, False, 98.5)
    with pytest.raises(ValueError):
        Settings.parsed({"no_such": "1"})
    with pytest.raises(ValueError):
        Settings.parsed({"dry_run": "perhaps"})


def zipped(parts):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for name, text in parts.items():
            z.writestr(name, text)
    return out.getvalue()


def test_office_files(spark, tmp_path):
    w = 'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"'
    para = lambda *runs: f"<w:p>{''.join(runs)}</w:p>"
    run = lambda t: f"<w:r><w:t>{t}</w:t></w:r>"
    body = para(run("Costs fell "), run("by a third")) + para(run("last of the page"), '<w:r><w:br w:type="page"/></w:r>', run("next page")) + para() + para("<w:r><w:lastRenderedPageBreak/></w:r>", run("third &amp; last"))
    (tmp_path / "a.docx").write_bytes(zipped({"word/document.xml": f"<w:document {w}><w:body>{body}</w:body></w:document>"}))
    ns = 'xmlns:a="http://schemas.openxmlformats.org/drawingml/2006/main" xmlns:p="http://schemas.openxmlformats.org/presentationml/2006/main"'
    shape = lambda t, y=None: f"<p:sp><p:spPr>{'' if y is None else f'<a:xfrm><a:off x=\"0\" y=\"{y}\"/><a:ext cx=\"1\" cy=\"100\"/></a:xfrm>'}</p:spPr><p:txBody><a:p><a:r><a:t>{t}</a:t></a:r></a:p></p:txBody></p:sp>"
    slide = lambda *shapes: f"<p:sld {ns}><p:cSld><p:spTree>{''.join(shapes)}</p:spTree></p:cSld></p:sld>"
    parts = {"ppt/presentation.xml": f'<p:presentation {ns}><p:sldSz cx="100" cy="1000"/></p:presentation>', "ppt/slides/slide10.xml": slide(shape("tenth")), "ppt/slides/slide2.xml": slide(shape("Footer", 900), shape("Body text"), shape(" ")), "ppt/slides/slide1.xml": slide()}
    (tmp_path / "b.pptx").write_bytes(zipped(parts))
    got = sorted((r["filename"], r["page_no"], r["block_no"], r["text"]) for r in documents.blocks(spark, str(tmp_path)).collect() if r["text"])
    assert got == [("a.docx", 1, 0, "Costs fell by a third"), ("a.docx", 1, 1, "last of the page"), ("a.docx", 2, 0, "next page"), ("a.docx", 3, 0, "third & last"), ("b.pptx", 2, 0, "Footer"), ("b.pptx", 2, 1, "Body text"), ("b.pptx", 3, 0, "tenth")]
    margins = {r["text"] for r in documents.blocks(spark, str(tmp_path)).filter(assembly.in_margin(0.12)).collect() if r["text"]}
    assert margins == {"Footer"}
    assert assembly.page_counts(documents.blocks(spark, str(tmp_path))).orderBy("filename").collect()[1]["n_pages"] == 3


def test_pdf_adapter(monkeypatch):
    """The adapter against the library's interface: blocks of text, image blocks and blank pages."""
    import sys
    import types

    class Page:
        rect = types.SimpleNamespace(height=700)

        def __init__(self, blocks):
            self.blocks = blocks

        def get_text(self, kind):
            assert kind == "blocks"
            return self.blocks

    class Doc(list):
        def __enter__(self):
            return self

        def __exit__(self, *a):
            pass

    pages = [Page([(0, 10, 1, 20, "one", 0, 0), (0, 30, 1, 40, "<image>", 1, 1), (0, 50, 1, 60, "  ", 2, 0), (0, 70, 1, 80, "two", 3, 0)]), Page([])]
    monkeypatch.setitem(sys.modules, "pymupdf", types.SimpleNamespace(open=lambda stream, filetype: Doc(pages)))
    assert documents.pdf_blocks(b"") == [(1, 0, "one", 10.0, 20.0, 700.0), (1, 3, "two", 70.0, 80.0, 700.0), (2, 0, None, 0.0, 0.0, 700.0)]
    monkeypatch.setitem(sys.modules, "pymupdf", None)
    with pytest.raises(RuntimeError):
        documents.pdf_blocks(b"")


def test_numbering_without_one_task(spark, monkeypatch):
    monkeypatch.setattr(requests, "LEAST_DEALT", 3)
    paths = spark.createDataFrame([(f"/d/{i:03}.pdf",) for i in range(50)] + [("/d/x.md",)], "path string")
    want = [(f"{i:03}.pdf", i + 1) for i in range(50)]
    assert [(r["filename"], r["idx"]) for r in requests.documents(paths).orderBy("idx").collect()] == want
    assert [(r["filename"], r["idx"]) for r in requests.documents(paths, 10).orderBy("idx").collect()] == want[:10]


def test_passages_of_any_length(spark):
    docs = spark.createDataFrame([("a", "the costly sale of ships"), ("b", "cost"), ("c", "x y"), ("d", "")], "filename string, full_cf string")
    needles = {1: "cost", 2: "ly sale", 3: "y", 4: "costly sale of", 5: "ostly sale of shi", 6: "", 7: "absent words here", 8: "ale of s"}
    got = {tuple(r) for r in ladder.located(spark.createDataFrame(list(needles.items()), "key int, text string"), docs).collect()}
    texts = {r["filename"]: r["full_cf"] for r in docs.collect()}
    assert got == {(k, f, t.find(n)) for k, n in needles.items() for f, t in texts.items() if n and n in t}
    assert ladder.located(spark.createDataFrame([], "key int, text string"), docs).count() == 0


def test_http_batches(spark, tmp_path):
    import http.server
    import threading

    seen = []

    class Server(http.server.BaseHTTPRequestHandler):
        def _give(self, body, code=200):
            self.send_response(code)
            self.end_headers()
            self.wfile.write(body)

        def do_POST(self):  # noqa: N802
            seen.append((self.path, self.rfile.read(int(self.headers["content-length"]))))
            self._give(b'{"id": "f1"}' if self.path == "/files" else b'{"id": "b1"}')

        def do_GET(self):  # noqa: N802
            url = f"http://127.0.0.1:{self.server.server_port}/results"
            self._give(json.dumps({"processing_status": "ended", "results_url": url, "request_counts": {"succeeded": 1}}).encode() if "batches" in self.path else json.dumps({"custom_id": "req-0001-a_pdf", "result": {"type": "succeeded", "message": {"content": [{"type": "text", "text": "{}"}]}}}).encode())

        def log_message(self, *a):
            pass

    server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Server)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    try:
        (tmp_path / "a.pdf").write_bytes(b"%PDF")
        p = HttpBatchProvider(spark, Settings(model="m"), f"{tmp_path}/landing", f"http://127.0.0.1:{server.server_port}", {"x-key": "k"})
        files = p.upload(documents.discover(spark, str(tmp_path)))
        asked = requests.request_matrix(files, prompts.analysis_prompts(derived.labels(spark))).filter("category = 'Methods'")
        status = p.poll(p.submit("Methods", asked))
        path = p.fetch("Methods", status)
        assert b"%PDF" in seen[0][1] and len(json.loads(seen[1][1])["requests"]) == 1
        assert responses.results(wire.read_records(spark, path)).first()["text"] == "{}"
    finally:
        server.shutdown()


def test_merge_runs(spark):
    run = lambda rows: spark.createDataFrame(rows, "snippet_id string, finding_hash string")
    got = responses.merge_runs(run([("a", "1"), ("b", "2")]), run([("c", "2"), ("d", "3")]))
    assert {tuple(r) for r in got.collect()} == {("a", "1"), ("b", "2"), ("d", "3")}


def test_stream(spark, tmp_path, corpus):
    from quotarium.streaming.landing import paced_usage, verify_landing

    folder = tmp_path / "landing" / "category=Barriers"
    folder.mkdir(parents=True)
    record = lambda cid, text: json.dumps({"custom_id": cid, "result": {"type": "succeeded", "text": text}}) + "\n"
    (folder / "1.jsonl").write_text(record("req-0001-a_pdf", answer(GOOD | {"snippet": "costs fell by one third"})) + "oops\n")
    files = spark.createDataFrame([("a.pdf", "id", 1)], "filename string, file_id string, idx long")
    go = lambda: verify_landing(spark, f"{tmp_path}/landing", files, derived.labels(spark), corpus, f"{tmp_path}/out", f"{tmp_path}/cp", run_ts="t").awaitTermination()
    go()
    (folder / "2.jsonl").write_text(record("req-0001-a_pdf", answer(GOOD | {"snippet": "nineteen lighthouses stand elsewhere"})))
    go()
    assert {r["verification_status"] for r in spark.read.parquet(f"{tmp_path}/out/verified").collect()} == {S.VERIFIED, S.NOT_FOUND}
    assert spark.read.parquet(f"{tmp_path}/out/errors").first()["error_type"] == "api_error"
    spark.range(10).select(F.timestamp_seconds(F.col("id") * 30).alias("ts"), F.lit(5).alias("tokens")).write.parquet(f"{tmp_path}/usage")
    events = spark.readStream.schema("ts timestamp, tokens int").parquet(f"{tmp_path}/usage")
    paced_usage(spark, events, f"{tmp_path}/cp2", f"{tmp_path}/paced", late="0 seconds").awaitTermination()
    assert all(r["tokens"] == 10 for r in spark.read.parquet(f"{tmp_path}/paced").collect())


@pytest.fixture
def wide_batches(spark):
    """Spark's own limits of Arrow batches for a test, and what was set before after it."""
    keys = ("spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.execution.arrow.maxBytesPerBatch")
    was = {k: spark.conf.get(k) for k in keys}
    for k in keys:
        spark.conf.unset(k)
    yield lambda: (spark.conf.get(keys[0]), spark.conf.get(keys[1]).rstrip("b")) == (str(storage.BATCH_ROWS), str(storage.BATCH_BYTES))
    for k, v in was.items():
        spark.conf.set(k, v)


def test_texts_reach_python_in_small_batches(spark, wide_batches):
    assert not wide_batches()
    seen = assembly.texts_as_documents(spark.createDataFrame([("a",)], "text string"), F.lit("f"))
    assert wide_batches() and seen.count() == 1


def test_full_windows_are_summed_in_one_pass(spark):
    """Many requests in a window, some at the same time, against plain loops; no frame that is summed anew for each row. A lane may be null."""
    rng, least = random.Random(3), 60_000_000
    rows = [(rng.choice(["a", "b", None]), i, rng.randrange(-400, 900) * 500_000, rng.choice([0, -1, None, 5, 7, 30, 90])) for i in range(900)]
    got = pacing.window_usage(spark.createDataFrame(rows, "lane string, seq long, ts_us long, tokens long"), Settings(tokens_per_minute=2000, safety_margin=0.5))
    assert "RangeFrame" not in got._jdf.queryExecution().optimizedPlan().toString()
    got, kept = got.collect(), [r for r in rows if r[3] and r[3] > 0]
    assert len(got) == len(kept)
    for r in got:
        past = sorted((ts, seq, n) for lane, seq, ts, n in kept if lane == r["lane"] and (ts, seq) < (r["ts_us"], r["seq"]))
        inside = [x for x in past if x[0] >= r["ts_us"] - least]
        last = [n for _, _, n in past[-5:]]
        estimate = max(sum(last) // len(last), 1) if last else 1
        assert (r["used"], r["oldest_us"], r["estimate"]) == (sum(n for *_, n in inside), inside[0][0] if inside else None, estimate)
        assert r["admitted"] == (not inside or r["used"] + estimate <= 1000)


@pytest.mark.parametrize("seconds", [1, 60, 3600])
def test_used_and_estimate_by_themselves(spark, seconds):
    """Each alone gives the columns of window_usage, and what is used those of plain loops; windows of few and of all requests."""
    rng, s = random.Random(seconds), Settings(window_seconds=seconds)
    rows = [(rng.choice(["a", "b", None]), i, rng.choice([None, *[rng.randrange(-400, 900) * 250_000] * 9]), rng.choice([0, None, 5, 7, 30, 90])) for i in range(400)]
    log = spark.createDataFrame(rows, "lane string, seq long, ts_us long, tokens int")
    whole, kept = pacing.window_usage(log, s).persist(), [r for r in rows if r[3] and r[2] is not None]
    used = pacing.used_before(log, s)
    for part in (used, pacing.estimates(log, s)):
        assert sorted(map(repr, part.collect())) == sorted(map(repr, whole.select(part.columns).collect()))
    got = {r["seq"]: (r["used"], r["oldest_us"]) for r in used.collect()}
    assert len(got) == len(kept)
    for lane, seq, ts, _ in kept:
        inside = [(t, n) for own, i, t, n in kept if own == lane and (t, i) < (ts, seq) and t >= ts - seconds * 1_000_000]
        assert got[seq] == (sum(n for _, n in inside), min(inside)[0] if inside else None)


def test_quotes_reach_python_in_small_batches(spark, corpus, wide_batches):
    assert not wide_batches() and verdict(spark, corpus, LONG)["verification_status"] == S.VERIFIED and wide_batches()


def test_answers_reach_python_in_small_batches(spark, wide_batches):
    row = [("Methods", 1, "f", True, '{"findings": []}', None)]
    answers = spark.createDataFrame(row, "category string, response_ord long, filename string, success boolean, text string, error_message string")
    assert not wide_batches() and responses.decoded(answers, derived.labels(spark)).count() == 1 and wide_batches()


def test_scores_reach_python_in_small_batches(spark, wide_batches):
    v = spark.createDataFrame([("x", 96.65, "t")], "snippet_id string, match_score double, matched_text string")
    assert not wide_batches() and audit.audit(v).count() == 1 and wide_batches()


def test_passages_reach_python_in_small_batches(spark, corpus, wide_batches):
    assert not wide_batches()
    found = ladder.located(spark.createDataFrame([(1, LONG)], "key int, text string"), corpus)
    assert wide_batches() and found.count() == 1


def test_blocks_meet_once(spark):
    """Documents in one shuffle, equal to the plain steps; odd spaces, blank pages, numbers that are missing, blocks out of order."""
    rng = random.Random(5)
    texts = ["Journal 1", "Journal 22", "journal \u0663", "\u00c9t\u00e9 7", " \u00a0\x85\x1c", "", None, "body - \u00df \ufb01", "inno-\nvation", "12"]
    rows = [(rng.choice(["a", "b", "c", "d", None]), rng.choice([1, 2, 3, 4, 5, 9, None]), rng.choice([0, 1, 2, 3, None]), rng.choice(texts), rng.choice([10.0, 300.0, 740.0, None]), rng.choice([20.0, 340.0, 790.0]), rng.choice([792.0, 792.0, None])) for _ in range(300)]
    b = spark.createDataFrame([*rows, ("one", 1, 0, "Journal 1", 10.0, 20.0, 792.0)], assembly.BLOCKS)
    for s in (Settings(), Settings(boilerplate_share=0.5), Settings(strip_boilerplate=False)):
        got, want = assembly.from_blocks(b, s), assembly.doc_texts(assembly.page_texts(b, s), s)
        assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
    assert assembly.from_blocks(b)._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
