import json

from pyspark.sql import functions as F

from tripweave.functions import prompts
from tripweave.functions.taxonomy import has_sufficient_text, parse_response, validate_attraction_tags, validate_festival_themes
from tripweave.functions.calls import call_batches, one_by_one
from tripweave.operators import enrich

L = F.lit


def checked(value, answer):
    return value(validate_attraction_tags(parse_response(L(json.dumps(answer)))))


def test_tag_validation(value):
    out = checked(value, {"indoor_outdoor": "outdoor", "vibe_tags": ["calm", "bad", 7, "retro", "cozy", "rural", "local", "craft"], "experience_tags": "picnic", "companion_fit": ["kids"]})
    assert out["valid"] and out["indoor_outdoor"] == "outdoor" and out["vibe_tags"] == ["calm", "retro", "cozy", "rural", "local"]
    assert out["experience_tags"] == [] and out["companion_fit"] == ["kids"]
    extra = checked(value, {"indoor_outdoor": "sky", "zz": 1, "aa": 2})
    assert not extra["valid"] and extra["extra_fields"] == ["aa", "zz"] and extra["indoor_outdoor"] == "unknown"


def test_theme_validation(value):
    def run(answer):
        return tuple(value(validate_festival_themes(parse_response(L(json.dumps(answer))))))

    assert run({"primary_theme": "예술·감성", "theme_tags": ["역사·전통", "x", "미식·노포", "온천·휴양", "바다·해안"]}) == (True, "예술·감성", ["예술·감성", "역사·전통", "미식·노포"])
    assert run({"primary_theme": "예술·감성", "theme_tags": ["역사·전통", "예술·감성"]}) == (True, "예술·감성", ["역사·전통", "예술·감성"])
    assert run({"primary_theme": "x", "theme_tags": ["역사·전통"]}) == (False, None, [])
    assert run({"primary_theme": "예술·감성"}) == (True, "예술·감성", ["예술·감성"])


def test_responses(value):
    fenced = "```JSON\n{\"a\": 1}\n```"
    assert value(*[parse_response(L(t)).isNotNull() for t in (fenced, " {} ", "[1]", "{", "")]) == (True, True, False, False, False)
    assert value(has_sufficient_text(L(None).cast("string"), L(" " * 40 + "x")), has_sufficient_text(L("가" * 30))) == (False, True)


def test_attraction_prompt_limit(spark):
    rows = [("attraction", "1", "t", "d" * n, ["a", "b"], "", "addr") for n in (0, 10, 11_500, 40_000)]
    df = spark.createDataFrame(rows, "entity_type string, content_id string, title string, description string, theme_tags array<string>, parking string, address string")
    out = [r[0] for r in df.select(prompts.attraction_prompt(df.schema)).collect()]
    assert "description" not in out[0] and "parking" not in out[0] and "theme_tags: a, b" in out[0]
    assert len(out[1]) < 12_000 and len(out[2]) == len(out[3]) == 12_000
    assert out[3].endswith(prompts.ATTRACTION_TAIL) and "\naddress: addr" in out[3]


def test_festival_prompt(spark):
    df = spark.createDataFrame([("festival", "1", " ", "p q", "x")], "entity_type string, content_id string, title string, program string, phone string")
    text = df.select(prompts.festival_prompt(df.schema, "theme set")).first()[0]
    assert "title" not in text and "phone" not in text and "program: p q\n\n[theme set]" in text


def items(spark, kind):
    rows = [("1", kind, "a" * 40), ("2", "other", "a" * 40), ("3", kind, "b" * 41), ("4", kind, "c" * 42), ("5", kind, "short"), ("6", kind, "d" * 43)]
    return spark.createDataFrame(rows, "content_id string, entity_type string, description string")


def test_enrichment_batch(spark):
    df = items(spark, "attraction")

    def model(prompt):
        if "aaaa" in prompt:
            return '{"indoor_outdoor": "indoor", "vibe_tags": ["calm"]}'
        if "bbbb" in prompt:
            raise ValueError("broken")
        if "cccc" in prompt:
            return '{"indoor_outdoor": "unknown"}'
        if "dddd" in prompt:
            return '{"x": 1}'
        raise TimeoutError("timeout")

    out = {r["content_id"]: r for r in enrich.enrich_attractions(df, one_by_one(_quick(model))).collect()}
    assert out["1"]["result"]["status"] == "succeeded" and out["1"]["result"]["vibe_tags"] == ["calm"]
    assert out["1"]["enrichment"]["input_hash"].startswith("sha256:") and out["1"]["enrichment"]["model_id"] == enrich.MODEL_ID
    assert (out["2"]["result"]["status"], out["2"]["result"]["error_code"]) == ("failed", "model_error")
    assert (out["3"]["result"]["error_code"], out["4"]["result"]["status"], out["6"]["result"]["error_code"]) == ("validation_error", "skipped", "validation_error")
    assert out["5"]["result"]["error_code"] == "timeout" and out["5"]["enrichment"]["input_hash"] is None
    # A second run over unchanged input does not ask again.
    history = spark.createDataFrame([(out["1"]["content_id"], *[out["1"]["enrichment"][c] for c in ("status", "input_hash", "prompt_version", "model_id")])], "content_id string, status string, input_hash string, prompt_version string, model_id string")
    again = enrich.with_history(df.where("content_id = '1'"), history, "content_id", "metadata_enrichment")

    def never(prompt):
        raise AssertionError("asked again")

    assert enrich.enrich_attractions(again, never).first()["result"]["status"] == "skipped"


def _quick(model):
    """Fails without waiting between retries."""

    def call(prompt):
        try:
            return model(prompt)
        except TimeoutError:
            import time

            time.sleep = lambda _: None
            raise

    return call


def test_classification_batch(spark):
    df = items(spark, "festival").withColumns({"theme": L("old"), "theme_tags": F.array(L("old"))})

    def model(prompt):
        return '```json\n{"primary_theme": "%s", "theme_tags": []}\n```' % ("바다·해안" if "aaaa" in prompt else "x")

    results = enrich.classify_festivals(df, one_by_one(model))
    out = {r["content_id"]: r["result"] for r in results.collect()}
    assert (out["1"]["status"], out["1"]["theme_tags"]) == ("succeeded", ["바다·해안"])
    assert out["2"]["error_code"] == "invalid_entity_type" and out["5"]["status"] == "review_required" and out["3"]["error_code"] == "validation_error"
    counts = {r["status"]: r["item_count"] for r in enrich.batch_counts(results).collect()}
    assert counts == {"succeeded": 1, "failed": 4, "review_required": 1}
    assert {r["content_id"] for r in enrich.failed_results(results).collect()} == {"2", "3", "4", "6"}


def test_calls_in_batches():
    seen, failing = [], {"b", "d"}

    def model(texts):
        seen.append(list(texts))
        if "e" in texts and len(texts) > 1:
            raise RuntimeError("whole call")
        out = [ValueError(t) if t == "x" else TimeoutError(t) if t in failing else t.upper() for t in texts]
        failing.discard("b")
        return out

    texts = list("abcdefx")
    got = call_batches(model, texts, batch_size=2, concurrency=1, retries=1, again=lambda e: isinstance(e, TimeoutError), pause=0)
    assert [g if isinstance(g, str) else type(g).__name__ for g in got] == ["A", "B", "C", "TimeoutError", "E", "F", "ValueError"]
    assert max(map(len, seen)) == 2 and ["e"] in seen and ["f"] in seen
    short = call_batches(lambda t: [], ["a", "b"], pause=0)
    assert all(isinstance(g, ValueError) for g in short) and call_batches(model, []) == []


def test_prompts_are_held_a_step_at_a_time():
    import tracemalloc

    import pyarrow as pa

    prompts = pa.array([None, *("x" * 1_000_000 for _ in range(40)), None, "down"])
    calls = []

    def call(texts):
        calls.append(sum(map(len, texts)))
        return [ValueError("no") if t == "down" else str(len(t)) for t in texts]

    tracemalloc.start()
    told = enrich.answers(prompts, call).to_pylist()
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    none = {"text": None, "error": None}
    assert told == [none, *[{"text": "1000000", "error": None}] * 40, none, {"text": None, "error": "validation_error"}]
    assert max(calls) <= enrich.STEP_BYTES + 1_000_000 and peak < 16_000_000
    assert enrich.answers(pa.array([], pa.string()), call).to_pylist() == []
