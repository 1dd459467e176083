import json

import pytest
from pyspark.sql import functions as F

from staylift.functions import formats as fmt
from staylift.functions.text import WORD_FIXES, facts, fix_words, strip
from staylift.operators import copy, render
from staylift.operators.filters import parse_ids
from staylift.sources.templates import bundled, load_template


def one(spark, column, **values):
    schema = ", ".join(f"{k} {t}" for k, (_, t) in values.items())
    return spark.createDataFrame([tuple(v for v, _ in values.values())], schema).select(column).first()[0]


@pytest.mark.parametrize("raw, shown", [
    ("0212345678", "021-234-5678"), ("01012345678", "010-1234-5678"), (" 0212345678 ", "021-234-5678"), ("12345", "12345"),
    ("", "번호없음"), (None, "번호없음"), ("+821012345678", "+821012345678"), ("\t01012345678\r\n", "010-1234-5678"), ("\u30000212345678\xa0", "021-234-5678"),
])
def test_phone(spark, raw, shown):
    assert one(spark, fmt.phone(F.col("p")), p=(raw, "STRING")) == shown


def test_numbers(spark):
    assert one(spark, fmt.thousands(F.col("n")), n=(-1234567, "LONG")) == "-1,234,567"
    for value, text in ((0.25, "0.3"), (12.0, "12.0"), (1.04, "1.0")):
        assert one(spark, fmt.one_decimal(F.col("x")), x=(value, "DOUBLE")) == text
    for rate, pct in (("0.15", 15), ("0.30", 30), (None, 0)):
        assert one(spark, fmt.rate_percent(F.col("r").cast("decimal(4,2)")), r=(rate, "STRING")) == pct
    for change, arrow, color, card, prompt in (
        (12.5, "▲ 12.5%", "#1b6f4a", "+12.5%", "+12.5%"), (-3.0, "▼ 3.0%", "#a8231c", "-3.0%", "-3.0%"), (0.0, "—", "#5f5f5f", "0.0%", "+0.0%")
    ):
        c = F.col("c")
        made = one(
            spark,
            F.array(fmt.change_arrow(c), fmt.change_color(c), fmt.signed_percent(c, plus_at_zero=False), fmt.signed_percent(c, plus_at_zero=True)),
            c=(change, "DOUBLE"),
        )
        assert made == [arrow, color, card, prompt]


def test_word_fixes_apply_in_order(spark):
    text = "쿠pon이 쿠PON COUPONs 이ven트 push PUSHed marketing Package packages"
    expected = text
    for wrong, right in WORD_FIXES:
        expected = expected.replace(wrong, right)
    assert one(spark, fix_words(F.col("t")), t=(text, "STRING")) == expected
    words = [w for w, _ in WORD_FIXES]
    assert words.index("쿠pon") < words.index("쿠pon이") and len(words) == 18


def python_copy(response: str):
    """What a strict reader makes of a response; None if it fails."""
    text = response.strip()
    if "```" in text:
        text = text.split("```")[1]
        if text.startswith("json"):
            text = text[4:]
    try:
        found = json.loads(text)
        return tuple(found.get(k, "").replace("push", "푸시") for k in ("subject", "body"))
    except Exception:
        return None


RESPONSES = [
    '{"subject": "push", "body": "a\\nb"}', '```json\n{"subject": "s", "body": "b"}\n```', '```\n{"body": "only"}\n```', "  {} ",
    'before ```json{"subject": "s"}``` after', '[{"subject": "s", "body": "b"}]', '{"subject": "s", "body": "b"', "plain", "", "{'subject': 's'}",
    '{"subject": "raw\nnewline"}', '{"subject": null, "body": "b"}', '{"subject": "s"} trailing', '"text"', "5", '{"subject": "\\u00e9 /"}',
    '{"subject": "s", "extra": {"a": [1]}}', "```json\nnot json\n```",
]


def test_parse_copy_like_a_strict_reader(spark):
    df = spark.createDataFrame(list(enumerate(RESPONSES)), "acm_id LONG, response STRING")
    good = {r.acm_id: (r.subject, r.body) for r in copy.parse_copy(df).collect()}
    bad = {r.acm_id: r.response for r in copy.copy_rejects(df).collect()}
    expected = {i: python_copy(r) for i, r in enumerate(RESPONSES)}
    assert good == {i: c for i, c in expected.items() if c is not None}
    assert bad == {i: RESPONSES[i] for i, c in expected.items() if c is None}


def test_last_copy_wins(spark):
    df = spark.createDataFrame([(1, 2, "new", "b"), (1, 1, "old", "a"), (2, 1, "x", "y")], "acm_id LONG, turn INT, subject STRING, body STRING")
    assert {r.acm_id: r.subject for r in copy.last_copy(df, "turn").collect()} == {1: "new", 2: "x"}


def test_repeated_copies_do_not_multiply_targets(spark):
    targets = spark.createDataFrame([(1,), (2,), (2,)], "acm_id LONG")
    copies = spark.createDataFrame([(1, "a", "x"), (1, "b", "y"), (3, "c", "z")], "acm_id LONG, subject STRING, body STRING")
    joined = copy.with_copy(targets, copies, required=False).collect()
    assert sorted((r.acm_id, r.subject, r.has_copy) for r in joined if r.acm_id == 1) == [(1, "b", True)]
    assert [(r.subject, r.has_copy) for r in joined if r.acm_id == 2] == [(None, False)] * 2
    assert [r.acm_id for r in copy.with_copy(targets, copies, required=True).collect()] == [1]


def test_the_last_readable_copy_is_joined(spark):
    targets = spark.createDataFrame([(1,), (2,), (3,)], "acm_id LONG")
    rows = [(1, 1, '{"subject": "z first", "body": ""}'), (1, 2, '{"subject": "a last", "body": ""}'), (1, 3, "broken"), (2, 1, "broken"), (9, 1, '{"subject": "other"}')]
    responses = spark.createDataFrame(rows, "acm_id LONG, made INT, response STRING")
    joined = copy.with_copy(targets, responses, required=False, order="made")
    assert sorted((r.acm_id, r.subject, r.has_copy) for r in joined.collect()) == [(1, "a last", True), (2, None, False), (3, None, False)]


def test_responses_are_cut_to_the_list_before_they_are_parsed_once(spark):
    targets = spark.range(3).withColumnRenamed("id", "acm_id")
    responses = spark.range(9).selectExpr("id AS acm_id", "id AS made", "'{}' || id AS response")
    plan = copy.with_copy(targets, responses, required=True, order="made")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1
    assert plan.index("from_json") < plan.index("LeftSemi")  # the semi join is further down
    for made in (copy.parse_copy(responses), copy.copy_rejects(responses)):
        assert made._jdf.queryExecution().optimizedPlan().toString().count("from_json") == 1


def test_facts_leave_out_what_is_unknown_or_unwanted(spark):
    text = facts(("a", F.col("x")), ("b", F.col("y")), ("c", F.col("x"), F.col("x") > 1), ("d", F.col("x"), F.col("x") > 0))
    assert one(spark, text, x=(1, "INT"), y=(None, "STRING")) == "a: 1\nd: 1"


UPSELL = dict(
    acm_id=5, host_name=None, acm_name="[a/b] {{acm_id}}", res_90d=3, gmv_90d=1234567, advert_name=None, avg_res=1.25, ad_acm_cnt=2,
    extra_rev_90d=999, rec_package="P", rec_rate=0.15, body="hi {{host_name}}\nthere",
)
UPSELL_SCHEMA = (
    "acm_id LONG, host_name STRING, acm_name STRING, res_90d LONG, gmv_90d LONG, advert_name STRING, avg_res DOUBLE, ad_acm_cnt LONG, "
    "extra_rev_90d LONG, rec_package STRING, rec_rate DOUBLE, body STRING"
)


def test_render_upsell_fills_in_order_and_drops_the_block(spark, tmp_path):
    path = tmp_path / "t.html"
    path.write_text("{{host_name}}|{{acm_name}}|{{gmv_90d_fmt}}|{{current_pkg}}|{{#if_compare}}\n{{avg_res}} of {{ad_acm_cnt}}\n{{/if_compare}}|{{rec_rate_pct}}|{{email_body}}")
    rows = [tuple(UPSELL.values()), tuple({**UPSELL, "ad_acm_cnt": 0, "advert_name": "N", "host_name": "H"}.values())]
    df = spark.createDataFrame(rows, UPSELL_SCHEMA)
    html = [r.html for r in render.render_upsell(df, load_template(spark, str(path))).orderBy("host_name").collect()]
    # A value inserted early may hold a later key's mark, which is then filled; an earlier key's is not.
    assert html == [
        "호스트|[a/b] 5|1,234,567|미가입|\n1.3 of 2\n|15|hi {{host_name}}\nthere", "H|[a/b] 5|1,234,567|N||15|hi {{host_name}}\nthere",
    ]


def test_bundled_templates_leave_no_mark(spark):
    df = spark.createDataFrame([tuple({**UPSELL, "acm_name": "n", "body": "b"}.values())], UPSELL_SCHEMA)
    assert "{{" not in render.render_upsell(df, bundled("upsell.html")).first().html
    report = df.selectExpr(
        "*", "'zero' AS perf", "0.0D AS change_pct", "0L AS res_this_month", "0L AS gmv_this_month", "2L AS res_last_month", "1.0D AS region_avg_res"
    )
    html = render.render_report(report, bundled("report.html"), F.lit("2025년 5월")).first().html
    assert "{{" not in html and "이용 중인 패키지" not in html


def test_ids_and_strip(spark):
    assert one(spark, parse_ids(F.col("c")), c=(" 12,7,,x, 12 ,-3,1.5,\t8\n", "STRING")) == [12, 7, -3, 8]
    assert one(spark, strip(F.col("c")), c=("\n\t a\nb \r\n", "STRING")) == "a\nb"
