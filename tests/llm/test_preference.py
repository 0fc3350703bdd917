import duckdb

from checks import compare
from millrace.llm import preference
from millrace.llm.queries import ORACLES, QUERIES
from tests.llm.helpers import FOLDER

TURNS = "pair_id long, turn long, role string, text string"


def test_query_matches_its_sql_and_runs_no_python(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{FOLDER}/conversations.parquet')")
    df = QUERIES["op1_preference_format"](spark, FOLDER)
    assert compare(df, con, ORACLES["op1_preference_format"]).startswith("ok")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


CHOSEN = [(1, 0, "system", "s"), (1, 1, "user", "u"), (1, 2, "assistant", "good"), (2, 0, "user", "same"), (3, 0, None, None), (3, 1, "assistant", "x"), (5, 7, "assistant", "b"), (5, 7, "assistant", "a"), (None, 0, "user", "lost"), (1, None, "user", "lost")]
REJECTED = [(1, 0, "system", "s"), (1, 1, "user", "u"), (1, 2, "assistant", "bad"), (1, 3, "user", "why"), (2, 0, "user", "same"), (3, 0, None, None), (4, 0, "user", "alone")]


def test_prompts_completions_and_masks(spark):
    found = preference.format_pairs(spark.createDataFrame(CHOSEN, TURNS), spark.createDataFrame(REJECTED, TURNS))
    rows = {(r["pair_id"], r["part"], r["turn"]): (r["rendered"], r["loss_from"]) for r in found.collect()}
    end = "<|end|>\n"
    head = len("<|assistant|>\n")
    whole = lambda t: (t, len(t))
    assert rows == {
        (1, "prompt", 0): whole("<|system|>\ns" + end), (1, "prompt", 1): whole("<|user|>\nu" + end),
        (1, "chosen", 2): ("<|assistant|>\ngood" + end, head), (1, "rejected", 2): ("<|assistant|>\nbad" + end, head),
        (1, "rejected", 3): whole("<|user|>\nwhy" + end), (2, "prompt", 0): whole("<|user|>\nsame" + end),
        (3, "prompt", 0): whole("<||>\n" + end), (3, "chosen", 1): ("<|assistant|>\nx" + end, head),
        (4, "rejected", 0): whole("<|user|>\nalone" + end), (5, "chosen", 7): ("<|assistant|>\na" + end, head),
    }
    one = {r["pair_id"]: r for r in preference.assembled(found).collect()}[1]
    assert one["prompt"] == "<|system|>\ns" + end + "<|user|>\nu" + end
    assert one["rejected"].startswith("<|assistant|>\nbad") and one["rejected"].endswith("why" + end)
    assert [tuple(m) for m in one["chosen_masks"]] == [(head, len("good" + end))]


def test_extra_columns_and_empty_tables(spark):
    chosen = spark.createDataFrame(CHOSEN, TURNS).selectExpr("*", "1 AS c", "2 AS part", "3 AS rendered", "4 AS loss_from", "5 AS differ")
    empty = spark.createDataFrame([], TURNS)
    assert preference.format_pairs(chosen, empty).where("part = 'prompt'").count() == 0
    assert preference.format_pairs(chosen, chosen).where("part <> 'prompt'").count() == 0
    assert preference.format_pairs(empty, empty).count() == 0
    assert preference.assembled(preference.format_pairs(empty, empty)).count() == 0
