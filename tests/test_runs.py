import json

import pytest

from siftline.functions.values import MISSING
from siftline.operators import evaluate, journal, responses
from siftline.plans import enrichment, evaluation
from siftline.streaming import journal_stream

SHEET = (
    "row_index int, siret string, company_name string, address string, postal_code string, city string, email string, phone string, website string, website_type string, status string, sources string, "
    "email_source string, phone_source string, website_source string, identity_source string, identity_match_type string, web_search_calls string"
)


def answer(email, site="https://atelier.fr/", page="https://atelier.fr/contact", verified=True, **more):
    fields = {"email": email, "phone": "04 78 00 11 22", "website": site, "website_type": "official_site", "email_source": page, "phone_source": "https://unseen.fr/", "website_source": page, "identity_verified": verified, "identity_match_type": "siret", "identity_source": page}
    return json.dumps({"usage": {"input_tokens": 10, "output_tokens": 5, "total_tokens": 0}, "output_text": "Here: " + json.dumps(fields), "output": [{"type": "web_search_call", "action": {"type": "search", "sources": [{"url": page}]}}]} | more)


def sheet(spark):
    rows = [("11111111111111", "Atelier"), ("22222222222222", "Moulin"), ("bad", "Sans numero"), ("33333333333333", "Forge"), ("44444444444444", "Deja vu"), (None, None)]
    table = [(i + 2, *r, None, None, "Lyon", *([None] * 12)) for i, r in enumerate(rows)]
    table[5] = (7, *([None] * 17))
    table[4] = (*table[4][:10], "success", *table[4][11:])
    return spark.createDataFrame(table, SHEET)


@pytest.fixture
def keep(spark, tmp_path):
    count = iter(range(1000))

    def write(df, name):
        path = str(tmp_path / f"{next(count)}-{name}")
        df.write.parquet(path)
        return spark.read.parquet(path)

    return write


def test_whole_run(spark, keep):
    answers = {"11111111111111": answer("info@atelier.fr", id=" r-1", model="m-2"), "22222222222222": "no json here", "44444444444444": answer("never@asked.fr")}
    out = enrichment.run(sheet(spark), responses.recorded(answers), keep, enrichment.Config(audit=True, wait_s=0))
    got = {r.row_index: r for r in out.sheet.collect()}
    assert (got[2].email, got[2].phone, got[2].website, got[2].status, got[2].email_source) == ("info@atelier.fr", MISSING, "https://atelier.fr/", "success", "https://atelier.fr/contact")
    assert got[3].status == "technical_error" and got[3].email is None
    assert got[4].status == "invalid_input" and got[5].status == "technical_error" and got[6].status == "success" and got[6].email is None and got[7].status is None
    c = out.counters.first()
    assert (c.scanned_rows, c.processed_rows, c.success_rows, c.technical_error_rows, c.invalid_input_rows) == (5, 4, 1, 2, 1)
    tokens = {r.row_index: (r.total_tokens, r.web_search_calls) for r in out.results.collect()}
    assert tokens[2] == (15, 1)
    assert {(r.row_index, r.response_id, r.model_snapshot, r.model_deployment) for r in out.results.filter("row_index = 2").collect()} == {(2, "r-1", "m-2", "recorded")}
    again = {r.row_index: (r.email, r.status) for r in enrichment.recover(sheet(spark), out.journal).collect()}
    assert again == {k: (r.email, r.status) for k, r in got.items()}
    untouched = enrichment.recover(sheet(spark), out.journal, enrichment.commit(spark, out.run))
    assert [r.status for r in untouched.orderBy("row_index").collect()] == [r.status for r in sheet(spark).orderBy("row_index").collect()]
    second = enrichment.run(out.sheet, responses.recorded({"22222222222222": answer("m@moulin.fr", verified=False)}), keep, enrichment.Config(wait_s=0))
    later = {r.row_index: r for r in second.sheet.collect()}
    assert second.run > out.run and {r.seq for r in second.journal.collect()} == {second.run}
    assert later[3].status == "not_found" and later[3].email == MISSING and later[2].email == "info@atelier.fr"


def test_run_reads_sites(spark, keep):
    page = "<p>Atelier, SIRET 111 111 111 11111, Lyon. Contact : atelier@exemple.fr</p>"
    store = spark.createDataFrame([("https://atelier.fr/", "https://atelier.fr/", page)], "requested string, url string, html string")
    out = enrichment.run(sheet(spark), responses.recorded({"11111111111111": answer(MISSING)}), keep, enrichment.Config(wait_s=0), store)
    got = {r.row_index: r for r in out.sheet.collect()}
    assert (got[2].email, got[2].phone) == ("atelier@exemple.fr", "04 78 00 11 22")


def test_settings():
    assert enrichment.Config().overridden(max_rows=None, tries=5).tries == 5
    for bad in ({"start_row": 1}, {"site_pages": 13}, {"concurrency": 0}, {"wait_s": -1.0}, {"context_size": "huge"}):
        with pytest.raises(ValueError, match=next(iter(bad))):
            enrichment.Config().overridden(**bad)


def test_calls_are_retried(spark):
    def make():
        seen = []

        def provider(request, key):
            seen.append(key)
            body = json.loads(request)
            if "flaky" in body["input"] and len([k for k in seen if k == key]) < 3:
                raise responses.Retryable("busy")
            if "down" in body["input"]:
                raise responses.Retryable("gone")
            if "cut" in body["input"] and body["max_output_tokens"] == responses.FIRST_CAP:
                return json.dumps({"status": "incomplete", "incomplete_details": {"reason": "max_output_tokens"}, "usage": {"input_tokens": 1, "output_tokens": 600, "total_tokens": 601}})
            return answer("a@b.fr")

        return provider

    rows = [(2, "flaky"), (3, "down"), (4, "cut"), (5, "fine")]
    asked = spark.createDataFrame([(i, json.dumps({"input": t, "max_output_tokens": responses.FIRST_CAP})) for i, t in rows], "row_index int, request string")
    got = responses.call(asked, make, tries=3, wait_s=0, concurrency=2).collect()
    by = {(r.row_index, r.attempt): r for r in got}
    assert set(by) == {(2, 0), (3, 0), (4, 0), (4, 1), (5, 0)}
    assert by[3, 0].error_type == "Retryable" and by[3, 0].raw is None and by[2, 0].error_type == ""
    usage = {r.row_index: r.total_tokens for r in responses.usage_by_row(spark.createDataFrame(got)).collect()}
    assert usage == {2: 15, 3: 0, 4: 616, 5: 15}


@pytest.mark.parametrize(("cap", "caps"), [(600, [600, 1200, 1200, 2400]), (2000, [2000, 4000, 2000, 4000])])
def test_caps_grow_and_never_shrink(spark, cap, caps):
    cut = json.dumps({"status": "incomplete", "incomplete_details": {"reason": "max_output_tokens"}})
    told = lambda request, key: json.dumps(json.loads(cut) | {"cap": json.loads(request)["max_output_tokens"]})
    asked = spark.createDataFrame([(2, json.dumps({"input": "x", "max_output_tokens": cap}))], "row_index int, request string")
    got = sorted(responses.call(asked, lambda: told, wait_s=0).collect(), key=lambda r: r.attempt)
    assert [json.loads(r.raw)["cap"] for r in got] == caps and [r.attempt for r in got] == [0, 1, 2, 3] and all(r.latency_seconds >= 0 for r in got)


def test_answers_with_unknown_values_are_generated_again_and_kept_for_diagnosis(spark):
    bad = json.dumps({"output_text": '{"website_type": "castle"}'})
    provider = lambda request, key: bad if key.endswith("-0") else answer("a@b.fr")
    asked = responses.requests(spark.createDataFrame([(2, "1" * 14, "A", None, None, None)], "row_index int, siret string, company_name string, address string, postal_code string, city string"), "m", "i", "{siret}", {}, effort="high")
    body = json.loads(asked.first().request)
    assert body["reasoning"] == {"effort": "high"} and body["text"]["format"]["strict"] is True and sorted(body["text"]["format"]["schema"]["required"]) == sorted(responses.FIELDS)
    assert "search_context_size" not in body["tools"][0] and body["text"]["format"]["schema"]["additionalProperties"] is False
    got = spark.createDataFrame(responses.call(asked, lambda: provider, wait_s=0).collect())
    assert got.count() == 2
    assert [(r.attempt, r.error_type) for r in responses.unreadable(got).collect()] == [(0, "UnknownValue")]


def test_answers_of_many_shapes(spark):
    raws = [
        answer("a@b.fr"), json.dumps({"output": [{"content": [{"text": {"value": '{"email": "v@b.fr"}'}}, {"json": {"email": 1}}]}]}),
        "not json", json.dumps({"output_text": '{"email": "x@b.fr", "identity_verified": true, "identity_match_type": "maybe", "sources": ["https://smuggled.fr"]}'}), json.dumps([1]), None,
    ]
    df = spark.createDataFrame([(i, r) for i, r in enumerate(raws)], "i int, raw string")
    read = responses.decoded(df.withColumn("answer", responses.answer_text(df.raw))).orderBy("i").collect()
    assert read[0].email == "a@b.fr" and read[0].decode_error == ""
    assert read[1].answer == '{"email": "v@b.fr"}\n{"email":1}' and read[1].email == MISSING
    assert [r.decode_error for r in read[2:]] == ["no JSON object", "unknown value", "no JSON object", "no JSON object"]
    counts = df.select(responses.search_calls(df.raw).alias("n"), *[c.alias(k) for k, c in responses.usage(df.raw).items()]).collect()
    assert [r.n for r in counts] == [1, 0, 0, 0, 0, 0] and [r.total_tokens for r in counts] == [15, 0, 0, 0, 0, 0]
    assert responses.first_object('a {"x": "}\\"{"} b}') == '{"x": "}\\"{"}' and responses.first_object("{") is None and responses.first_object(None) is None


def test_evaluation_report(spark, tmp_path):
    refs = spark.createDataFrame([(2, "1", "a", "success", "A@b.fr", "04 78", MISSING), (3, "2", "b", "not_found", MISSING, MISSING, MISSING)], "row_index int, siret string, company_name string, baseline_status string, baseline_email string, baseline_phone string, baseline_website string")
    both = evaluate.cross_deployments(refs, ["m1", "m2"])
    done = spark.createDataFrame([("m1", 2, "a@B.fr", "+33478", "https://a.fr", "", "", 1, 2, 3, 1, 1, 0.5), ("m1", 3, "c@d.fr", MISSING, MISSING, "", "", 1, 2, 3, 1, 0, 1.5), ("m2", 2, None, None, None, "Timeout", "x" * 900, 0, 0, 0, 0, 0, 0.0)],
        "deployment string, row_index int, candidate_email string, candidate_phone string, candidate_website string, error_type string, error_message string, input_tokens int, output_tokens int, total_tokens int, web_search_calls int, deterministic_fields_found int, latency_seconds double")
    rows = evaluate.evaluation_rows(both, done)
    got = {r.deployment: r for r in evaluate.model_summary(rows).collect()}
    assert (got["m1"].exact_matches, got["m1"].baseline_found_fields, got["m1"].exact_match_pct, got["m1"].new_contacts, got["m1"].average_latency_seconds) == (1, 2, 50.0, 2, 1.0)
    assert (got["m2"].error_rows, got["m2"].completed_rows, got["m2"].exact_match_pct, got["m2"].average_latency_seconds) == (2, 0, 0.0, 0.0)
    assert max(len(r.error_message) for r in rows.collect()) == 500
    paths = evaluate.write_report(rows, evaluate.model_summary(rows), str(tmp_path), "models", "sheet.xlsx")
    assert spark.read.option("header", True).csv(paths["csv"]).count() == 4 and spark.read.json(paths["json"]).count() == 2
    assert "csv" not in evaluate.write_report(rows.limit(0), evaluate.model_summary(rows), str(tmp_path / "none"), "models", "s")
    with pytest.raises(ValueError, match="name"):
        evaluate.cross_deployments(refs, ["a", " "])
    empty = evaluate.site_summary(spark.createDataFrame([], "error_type string, deterministic_fields_found int, baseline_email string, candidate_email string, baseline_phone string, candidate_phone string, identity_extraction_method string, legal_popup_detected boolean, pages_fetched int, latency_seconds double")).first()
    assert empty.requested_rows == 0 and empty.pages_fetched == 0 and empty.average_latency_seconds == 0.0


def test_journal_as_a_stream(spark, tmp_path):
    folder, out = tmp_path / "in", tmp_path / "out"
    folder.mkdir()
    line = lambda seq, row, status: json.dumps({"seq": seq, "version": 1, "row_index": row, "status": status, "recorded_at_utc": f"2026-01-01T0{seq}:00:00Z"})
    (folder / "a.json").write_text(line(1, 2, "success") + "\n" + line(2, 3, "not_found") + "\n")
    journal_stream.fold_available(journal_stream.records(spark, str(folder)), str(out), str(tmp_path / "cp")).awaitTermination(60)
    (folder / "b.json").write_text(line(3, 2, "technical_error") + "\n")
    journal_stream.fold_available(journal_stream.records(spark, str(folder)), str(out), str(tmp_path / "cp")).awaitTermination(60)
    assert spark.read.parquet(str(out)).count() == 3
    q = journal_stream.latest_status(journal_stream.records(spark, str(folder))).writeStream.format("memory").queryName("latest").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination(60)
    assert {r.row_index: (r.status, r.records) for r in spark.table("latest").collect()} == {2: ("technical_error", 2), 3: ("not_found", 1)}
    w = journal_stream.status_counts(journal_stream.records(spark, str(folder))).writeStream.format("memory").queryName("windows").outputMode("append").trigger(availableNow=True).start()
    w.awaitTermination(60)
    assert spark.table("windows").count() >= 1 and journal.SCHEMA.startswith("seq")


def done(spark, rows):
    """A sheet of finished rows: (siret, name, e-mail, phone, website, status)."""
    table = [(i + 2, r[0], r[1], None, None, "Lyon", r[2], r[3], r[4], None, r[5], *([None] * 7)) for i, r in enumerate(rows)]
    return spark.createDataFrame(table, SHEET)


def test_models_are_evaluated(spark, keep, tmp_path):
    known = done(spark, [("1" * 14, "Atelier", "INFO@atelier.fr", None, None, "success"), ("2" * 14, "Moulin", None, None, None, "not_found"), ("3" * 14, "Forge", None, None, None, None), ("bad", "X", None, None, None, "success")])
    answers = {"good": {"1" * 14: answer("info@atelier.fr"), "2" * 14: answer("m@moulin.fr")}, "poor": {"1" * 14: "nothing"}}
    rows, summary = evaluation.models(known, ["good", " poor", "good"], lambda name: responses.recorded(answers[name]), keep, enrichment.Config(audit=True, wait_s=0))
    assert tuple(rows.columns) == evaluate.MODEL_COLUMNS and len(rows.columns) == 37
    got = {(r.deployment, r.row_index): r for r in rows.collect()}
    assert set(got) == {(d, i) for d in ("good", "poor") for i in (2, 3)}
    r = got["good", 2]
    assert (r.candidate_status, r.email_exact_match, r.candidate_email, r.total_tokens, r.web_search_calls, r.error_type, r.audit_enabled) == ("success", True, "info@atelier.fr", 15, 1, "", True)
    assert json.loads(r.sources) == ["https://atelier.fr/contact"] and r.latency_seconds >= 0
    e = got["poor", 2]
    assert (e.candidate_status, e.error_type, e.sources, e.candidate_email, e.total_tokens, e.identity_match_type) == ("technical_error", "UnreadableAnswer", "[]", MISSING, 0, "none")
    totals = {r.deployment: r for r in summary.collect()}
    assert (totals["good"].exact_matches, totals["good"].exact_match_pct, totals["poor"].error_rows) == (1, 100.0, 2)
    path = evaluate.write_report(rows, summary, str(tmp_path), "models", "s")["csv"]
    assert next((tmp_path / path.rpartition("/")[2]).glob("*.csv")).read_bytes().startswith(b"\xef\xbb\xbfdeployment,")


def test_sites_are_evaluated(spark, keep):
    page = "<p>Atelier, SIRET 111 111 111 11111, Lyon. Contact : atelier@exemple.fr</p>"
    store = spark.createDataFrame([("https://atelier.fr/", "https://www.atelier.com/", page), ("https://other.fr/", "https://other.fr/", page)], "requested string, url string, html string")
    known = done(spark, [("1" * 14, "Atelier", None, "04 78 00 11 22", "https://atelier.fr/", "success"), ("2" * 14, "Moulin", None, None, "https://gone.fr/", "success"), ("3" * 14, "Forge", "f@g.fr", "04 78 00 11 22", "https://forge.fr/", "success")])
    rows, summary = evaluation.sites(known, store, keep)
    assert tuple(rows.columns) == evaluate.SITE_COLUMNS and len(rows.columns) == 21
    got = {r.row_index: r for r in rows.collect()}
    assert set(got) == {2, 3}
    assert (got[2].baseline_email, got[2].candidate_email, got[2].identity_extraction_method, got[2].phone_extraction_method) == (MISSING, "atelier@exemple.fr", "site_siret_or_siren", "baseline")
    assert json.loads(got[2].deterministic_pages) == ["https://www.atelier.com/"] and (got[3].candidate_email, got[3].identity_extraction_method) == (MISSING, "baseline")
    total = summary.first()
    assert (total.requested_rows, total.recovered_emails, total.rows_with_gain, total.pages_fetched, total.error_rows) == (2, 1, 1, 1, 0)


def test_journal_errors_name_the_line(spark, tmp_path):
    good = '{"seq": 1, "row_index": 2, "status": "success"}'
    (tmp_path / "j.jsonl").write_text("\n".join([good, "", good, "{broken", good, "{again"]) + "\n")
    with pytest.raises(journal.JournalError, match=r"line 4 of .*j\.jsonl"):
        journal.read(spark, str(tmp_path / "j.jsonl"))
