"""Chat formatting: exact round trips, the mask, and the cases of its docstring."""

import hashlib
from collections import defaultdict

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lodestack.llm import chat
from lodestack.llm.queries import op13_chat_template

CONTROL = ["<s>", "</s>", "[INST]", "[/INST]", "[ROLE]", "[/ROLE]", "[TURN]"]


def _digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def _expected(rows):
    by_id = defaultdict(list)
    for conv, turn, role, text in rows:
        by_id[conv].append((turn is not None, turn, role or "", text or ""))
    out = []
    for conv, turns in by_id.items():
        turns = [t[2:] for t in sorted(turns, key=lambda t: (t[0], t[1] or 0, t[2], t[3]))]
        learned = "".join(t for r, t in turns if r == "assistant")
        out.append((conv, len(turns), _digest("".join(f"{r}\n{t}\n" for r, t in turns)), len(learned), _digest(learned)))
    return sorted(map(str, out))


def _got(turns):
    return sorted(str(tuple(r)[:5]) for r in chat.digests(chat.formatted(turns)).collect())


SCHEMA = "conv_id long, turn long, role string, text string"


def test_query_reads_all_turns_back(spark):
    sf_dir = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").collect()]
    said = "</s>[INST] ok [/INST]"
    got = op13_chat_template(spark, sf_dir)
    assert sorted(str(tuple(r)[:5]) for r in got.collect()) == _expected([*rows, (-7, 0, "user", said), (-7, 1, "assistant", said)])
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))


def test_template_merges_turns_and_masks_the_answers(spark):
    rows = [(1, 0, "system", "be kind"), (1, 1, "user", "a"), (1, 2, "user", "b"), (1, 3, "assistant", "c"), (1, 4, "assistant", ""), (1, 5, "tool", "[TURN] <\\s>")]
    row = chat.formatted(spark.createDataFrame(rows, SCHEMA)).first()
    assert row.formatted == "<s>[INST][ROLE]system[/ROLE]be kind[/INST][INST]a[TURN]b[/INST]c[TURN]</s>[INST][ROLE]tool[/ROLE][\\TURN] <\\\\s>[/INST]"
    assert [s.text for s in row.segments if s.loss] == ["c", ""]
    assert _got(spark.createDataFrame(rows, SCHEMA)) == _expected(rows)


def test_cases(spark):
    rows = [(1, 2, "user", None), (1, 1, None, "x"), (1, 1, None, "x"), (1, None, "assistant", "y"), (1, 1, "", "a"), (None, 1, "user", "z"), (None, 1, "assistant", "z"), (3, 0, "assistant", None), (4, 0, None, None)]
    rows += [(5, i, "assistant" if i % 3 else "user", f"{c}{d}\n") for i, (c, d) in enumerate((c, d) for c in CONTROL for d in CONTROL)]
    rows += [(6, 0, "[INST]", "é😀" * 200_000), (6, 1, "</s>\n", "<\\\\/s>[\\INST]\\"), (6, 2, "assistant", "<"), (6, 3, "assistant", "/s>"), (6, 4, "assistant", "[/INST"), (6, 5, "assistant", "]")]
    turns = spark.createDataFrame([(*r, 1, "q") for r in rows], SCHEMA + ", turns int, segments string")
    assert _got(turns) == _expected(rows)
    assert chat.digests(chat.formatted(turns.limit(0))).count() == 0


PIECE = st.sampled_from([*CONTROL, "\\", "<", "[", "/", "s>", "]", "INST", "é", "\n", "user"])
TEXT = st.lists(PIECE, max_size=6).map("".join)


@settings(max_examples=12, deadline=None)
@given(st.lists(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "</s>", ""]), TEXT), min_size=1, max_size=6), min_size=1, max_size=30))
def test_any_texts_come_back(spark, conversations):
    rows = [(c, k, *t) for c, turns in enumerate(conversations) for k, t in enumerate(turns)]
    turns = spark.createDataFrame(rows, SCHEMA)
    assert _got(turns) == _expected(rows)
    texts = chat.formatted(turns).select(F.explode("segments").alias("s")).filter("s.loss").select("s.text")
    assert not any(c in r.text for r in texts.collect() for c in CONTROL)
