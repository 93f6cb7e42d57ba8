from __future__ import annotations

import hashlib
import itertools
import random

from pyspark.sql import functions as F

from waybill.llm import chat
from waybill.llm.queries import CONTROL_CONVERSATION, op10_chat_format

from .conftest import SF

TURNS = "conv_id long, turn long, role string, text string"


def expected(rows):
    """Per conversation: its turns in order, and its learnt text."""
    out = {}
    key = lambda r: (r[0] is not None, r[0] or 0)
    for conv, group in itertools.groupby(sorted(rows, key=key), key=lambda r: r[0]):
        turns = sorted(((r[1] is not None, r[1] or 0), r[2] or "", r[3] or "") for r in group)
        turns = [(role, text) for _, role, text in turns]
        out[conv] = turns, "".join(t for role, t in turns if role == "assistant")
    return out


def read(df):
    rows = df.select(
        "conv_id",
        "formatted",
        chat.read_back(F.col("formatted")).alias("turns"),
        chat.learned_text(F.col("formatted"), F.col("loss_spans")).alias("learned"),
    ).collect()
    return {r.conv_id: ([tuple(t) for t in r.turns], r.learned) for r in rows}, rows


def test_round_trip_of_control_strings(spark):
    rng = random.Random(12)
    alphabet = ["<s>", "</s>", "[INST]", "[/INST]", "\\", "<", ">", "[", "]", "/", "s", "\n", " ", "é", "👍", "\\/", "$1"]
    roles = ["user", "assistant", "system", "", "to\nol", "</s>", "a[INST]b\\", None]
    rows = [
        (c, t, rng.choice(roles), rng.choice([None, "", "".join(rng.choices(alphabet, k=rng.randrange(12)))]))
        for c in range(150)
        for t in range(rng.randrange(1, 9))
    ]
    rows += [(7, 1, "assistant", "tie"), (7, 1, "assistant", "tie"), (8, None, "user", "no turn"), (None, 0, "user", "x")]
    got, out = read(chat.render(spark.createDataFrame(rows, TURNS)))
    assert got == expected(rows)


def test_adjacent_turns_of_a_role_share_a_frame(spark):
    rows = [(1, 0, "user", "a"), (1, 1, "assistant", "b"), (1, 2, "assistant", "c\\"), (1, 3, "user", "d")]
    row = chat.render(spark.createDataFrame(rows, TURNS)).first()
    assert row.formatted == (
        "<s>user[INST]a[/INST]</s><s>assistant[INST]b[/INST][INST]c\\\\[/INST]</s><s>user[INST]d[/INST]</s>"
    )
    spans = [row.formatted[s.start - 1 : s.start - 1 + s.length] for s in row.loss_spans]
    assert spans == ["b", "c\\\\"]


def test_empty_tables_long_and_extra_columns(spark):
    assert chat.render(spark.createDataFrame([], TURNS)).collect() == []
    rows = [(1, t, "assistant" if t % 3 else "user", f"</s>{t} " * 2000, "x") for t in range(60)]
    turns = spark.createDataFrame(rows, f"{TURNS}, formatted string")
    got, _ = read(chat.render(turns))
    assert got == expected([r[:4] for r in rows])


def test_query_on_the_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    want = expected(rows + CONTROL_CONVERSATION)
    sha = lambda text: hashlib.sha256(text.encode()).hexdigest()
    out = op10_chat_format(spark, SF)
    got = {r.conv_id: r for r in out.collect()}
    assert got.keys() == want.keys()
    for conv, (turns, learned) in want.items():
        r = got[conv]
        assert r.n_turns == len(turns)
        assert r.turns_sha256 == sha("".join(f"{role}\n{text}\n" for role, text in turns))
        assert (r.loss_chars, r.loss_sha256) == (len(learned), sha(learned))
    assert "Python" not in out._jdf.queryExecution().executedPlan().toString()
