import hashlib
import re

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from strata.llm import chat as K
from tools.compare import rows_of

SCHEMA = "conv_id long, turn long, role string, text string, window int, kind string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def escape(text):
    return re.sub(r"<(\\*)\|", lambda m: "<\\" + m[1] + "|", text)


def n_tokens(text):
    return len(re.findall(r"[A-Za-z0-9]+|[^A-Za-z0-9\x00-\x20]", text)) + K.TURN_TOKENS


def plain(rows):
    """Windows turn by turn, conversation by conversation."""
    convs, out = {}, []
    for c, t, role, text in [*rows, (-1, 0, "user", K.PROBE), (-1, 1, "assistant", K.PROBE)]:
        role, text = role or "", text or ""
        convs.setdefault(c, []).append(((t is not None, t or 0), role, hashlib.md5(text.encode()).hexdigest(), text))
    for c, own in convs.items():
        own.sort(key=lambda x: x[:3])
        said = [(role, text) for _, role, _, text in own]
        piece = [K.START + escape(r).replace("\n", K.BREAK) + "\n" + escape(t) + K.END for r, t in said]
        first = 1 if said[0][0] == "system" else 0
        size = [n_tokens(t) for _, t in said]
        room = max(K.BUDGET - K.HISTORY - sum(size[:first]), K.LEAST)
        starts = [sum(size[first:k]) for k in range(len(size))]
        found = {}
        for k in range(first, len(said)):
            span, over = starts[k] // room, starts[k] % room > 0 and starts[k] + size[k] > (starts[k] // room + 1) * room
            found.setdefault((span, over), []).append(k)
        order = sorted(found) or [(0, False)]
        total = 0
        for w in order:
            new = found.get(w, [])
            past = [k for k in range(first, new[0]) if starts[k] >= starts[new[0]] - K.HISTORY] if new else []
            total += sum(len(piece[k]) for k in [*range(first), *past, *new])
        learned = "".join(t for r, t in said if r == "assistant")
        out.append((c, len(said), sha("".join(f"{r}\n{t}\n" for r, t in said)), len(learned), sha(learned), total,
                    len(order)))
    return sorted(out, key=str)


COLS = ("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "n_windows")


def answer(spark, rows, tmp_path):
    path = f"{tmp_path}/conversations.parquet"
    spark.createDataFrame([(*r, 7, "new") for r in rows], SCHEMA).repartition(3).write.mode("overwrite").parquet(path)
    got = sorted((tuple(r[c] for c in COLS) for r in K.query(spark, str(tmp_path)).collect()), key=str)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT conv_id, turn, role, text FROM read_parquet('{path}/*.parquet')")
    res = con.execute(K.ORACLE)
    names = [d[0] for d in res.description]
    assert sorted(names) == sorted(COLS)
    assert rows_of(res.fetchall(), names) == rows_of(got, list(COLS))
    return got


def long(conv, n, words, system=None):
    rows = [(conv, 0, "system", "rule " * system)] if system else []
    return rows + [(conv, k + 1, ("user", "assistant")[k % 2], f"turn{k} " + "word " * (words * (k % 3)))
                   for k in range(n)]


ODD = [(1, 0, "user", None), (1, 1, "assistant", ""), (2, 0, None, "no role"), (2, None, "assistant", "no number"),
       (None, 0, "user", "no id"), (None, 1, "assistant", "still none"), (3, 0, "system", "only rules"),
       (4, 0, "assistant", "same"), (4, 0, "assistant", "same"), (4, 0, "user", "a tie"), (5, 0, "two\nlines<|x", "r"),
       (6, 0, "user", "<|im_start|>a<|im_end|>\n<\\|b<\\\\|c<"), (6, 1, "assistant", "|<|\\<|nl|>é\U0001f600"),
       (7, 0, "system", "s " * 600), (7, 1, "user", "q"), (7, 2, "assistant", "very long " * 3000), (7, 3, "user", "t"),
       (-1, 5, "assistant", "more of it"), (8, 3, "system", "not first"), (8, 2, "user", "first")]
CASES = {"odd": ODD, "windows": long(1, 90, 40) + long(2, 60, 55, 30) + long(3, 30, 200, 500) + long(4, 3, 2),
         "short turns": long(1, 400, 1, 5), "one conversation": long(1, 1500, 25, 40), "none": []}


@pytest.mark.parametrize("case", CASES)
def test_equals_plain_and_sql(spark, tmp_path, case):
    assert answer(spark, CASES[case], tmp_path) == plain(CASES[case])


def test_windows_keep_the_budget_and_learn_once(spark):
    rows = CASES["windows"]
    got = K.windows(spark.createDataFrame([(*r, 7, "new") for r in rows], SCHEMA)).collect()
    seen = {}
    for w in sorted(got, key=lambda r: (r.conv_id, r.window)):
        turns = re.findall(r"<\|im_start\|>(.*?)\n(.*?)<\|im_end\|>\n", w.text, re.S)
        assert "".join(K.START + r + "\n" + t + K.END for r, t in turns) == w.text
        new = turns[w.n_context:]
        assert w.n_tokens <= K.BUDGET or len(new) == 1
        assert turns[0][0] == "system" or w.conv_id in (1, 4)
        past = turns[w.conv_id in (2, 3):w.n_context]
        assert sum(n_tokens(t) for _, t in past) <= K.HISTORY
        assert [w.text[m.start:m.end] for m in w.loss] == [t for r, t in new if r == "assistant"]
        seen.setdefault(w.conv_id, []).extend(new)
    for c, turns in seen.items():
        assert turns == [(r, t) for conv, _, r, t in rows if conv == c]
    assert any(w.n_context > 1 for w in got)


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("<\\|a>\n"), max_size=12))
def test_escape_leaves_no_control_and_is_undone(text):
    out = escape(text)
    assert "<|" not in out
    assert re.sub(r"<\\(\\*)\|", lambda m: "<" + m[1] + "|", out) == text


def test_one_conversation_is_split(spark):
    rows = [(1, k, "user", f"t{k}") for k in range(4000)]
    scratch = K.Scratch(spark, "test")
    dealt = K.deal(spark.createDataFrame([(*r, 7, "x") for r in rows], SCHEMA), "conv_id", ["turn"], scratch)
    sizes = [r["count"] for r in dealt.groupBy("_part").count().collect()]
    assert len(sizes) > 4 and max(sizes) < 1500
