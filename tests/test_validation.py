from pyspark.sql import functions as F

from feedlens.operators.validation import Limits, keep_first, validate, violations
from feedlens.sources.requests import flatten_requests, parse_requests, request_meta, requests_from_rows
from feedlens.operators.validation import corrupt_violations

from .conftest import sentences


def _req(spark, **kw):
    base = {"request_id": "r1", "baseline": [{"sentence": "ok", "id": "a"}]}
    base.update(kw)
    r = requests_from_rows(spark, [base])
    return flatten_requests(r), request_meta(r)


def test_strip_whitespace(spark):            # F1
    s, m = _req(spark, baseline=[{"sentence": "  Test  ", "id": "1"}])
    valid, viol = validate(s, m)
    assert [r.sentence for r in valid.collect()] == ["Test"]
    assert viol.count() == 0


def test_empty_after_strip(spark):            # F2
    s, m = _req(spark, baseline=[{"sentence": "   ", "id": "1"}])
    valid, viol = validate(s, m)
    msgs = [r.message for r in viol.collect()]
    assert any("cannot be empty" in x for x in msgs)
    assert valid.count() == 0


def test_too_long_sentence_and_id(spark):     # F3
    s, m = _req(spark, baseline=[{"sentence": "x" * 1001, "id": "1"},
                                 {"sentence": "fine", "id": "y" * 101}])
    _, viol = validate(s, m)
    rows = {(r.field, r.type) for r in viol.collect()}
    assert ("baseline.0.sentence", "string_too_long") in rows
    assert ("baseline.1.id", "string_too_long") in rows


def test_padded_overlong_rejected(spark):     # VAL1 on the raw value
    s, m = _req(spark, baseline=[{"sentence": " " + "x" * 999 + " ", "id": "1"}])
    _, viol = validate(s, m)
    assert viol.where("type = 'string_too_long'").count() == 1


def test_duplicate_ids(spark):                # F4
    s, m = _req(spark, baseline=[{"sentence": "a", "id": "1"}, {"sentence": "b", "id": "1"}],
                comparison=[{"sentence": "c", "id": "2"}, {"sentence": "d", "id": "2"},
                            {"sentence": "e", "id": "1"}])
    _, viol = validate(s, m)
    dup = {(r.field, r.message) for r in viol.where("type = 'value_error'").collect()}
    assert ("baseline", "Value error, Duplicate IDs found: 1") in dup
    assert ("comparison", "Value error, Duplicate IDs found: 2") in dup


def test_total_limit(spark):                  # F5
    b = [{"sentence": f"s{i}", "id": f"b{i}"} for i in range(600)]
    c = [{"sentence": f"s{i}", "id": f"c{i}"} for i in range(401)]
    s, m = _req(spark, baseline=b, comparison=c)
    _, viol = validate(s, m)
    msgs = [r.message for r in viol.where("severity = 'error'").collect()]
    assert any("Total sentences (1001) exceeds maximum (1000)" in x for x in msgs)


def test_empty_baseline_and_null_comparison(spark):   # F6
    s, m = _req(spark, baseline=[])
    _, viol = validate(s, m)
    assert viol.where("type = 'too_short' AND field = 'baseline'").count() == 1
    s2, m2 = _req(spark, comparison=None)
    assert validate(s2, m2)[1].count() == 0


def test_query_default(spark):                # F7
    r = requests_from_rows(spark, [{"request_id": "r", "baseline": [{"sentence": "a", "id": "1"}]}])
    assert request_meta(r).first().query == "overview"


def test_malformed_json(spark):               # F8 / SRC2
    bodies = spark.createDataFrame([("r1", "{'invalid': json}"),
                                    ("r2", '{"baseline": [{"sentence": "hi", "id": "1"}]}')],
                                   "request_id string, body string")
    req = parse_requests(bodies)
    bad = corrupt_violations(req).collect()
    assert [(r.request_id, r.type) for r in bad] == [("r1", "json_invalid")]
    assert flatten_requests(req).count() == 1


def test_keep_first(spark):                   # VAL11
    s = sentences(spark, ["a", "b", "c"], ids=["1", "1", "2"])
    kept = keep_first(s).orderBy("pos").collect()
    assert [(r.id, r.sentence) for r in kept] == [("1", "a"), ("2", "c")]


def test_corpus_limits_keep_whole_texts(spark):
    s = sentences(spark, ["y" * 5000])
    valid, viol = validate(s, limits=Limits.corpus(), strict=False)
    assert valid.first().sentence == "y" * 5000
    assert violations(s, limits=Limits.corpus()).count() == 0


def test_null_sentence_and_id_are_reported(spark):
    df = spark.createDataFrame([("r", "baseline", 0, "a", "fine"), ("r", "baseline", 1, "b", None),
                                ("r", "baseline", 2, None, "no id")],
                               "request_id string, dataset string, pos long, id string, sentence string")
    valid, viol = validate(df, limits=Limits.corpus(), strict=False)
    got = sorted((r.field, r.type) for r in viol.collect())
    assert got == [("baseline.1.sentence", "string_type"), ("baseline.2.id", "string_type")]
    assert [r.id for r in valid.collect()] == ["a"]
    assert validate(df, limits=Limits.corpus(), strict=True)[0].count() == 0


def test_null_text_becomes_a_reported_row(spark):
    from feedlens.sources.tables import documents_to_sentences
    docs = spark.createDataFrame([(1, None, "s", "en", 0)], "doc_id long, text string, source string, lang string, n_chars long")
    viol = violations(documents_to_sentences(docs), limits=Limits())
    assert [(r.type) for r in viol.collect()] == ["string_type"]
