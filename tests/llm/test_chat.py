import duckdb

from rolecall.llm.chat import ORACLE, rotate

SCHEMA = "conv_id long, turn long, role string, text string, part string, speaker string"


def brute(rows, system="system"):
    turns = {(c, t, r or "unknown", x or "") for c, t, r, x, *_ in rows}
    out = {}
    for conv in {c for c, *_ in turns}:
        own = sorted(((t is not None, t or 0, r, x) for c, t, r, x in turns if c == conv))
        for speaker in {r for _, _, r, _ in own if r != system}:
            text, mask = "", []
            for _, _, role, said in own:
                text += {system: "<|system|>\n", speaker: "<|assistant|>\n"}.get(role, f"<|user {role}|>\n")
                body = said.replace("<|", "< |") + "<|end|>\n"
                if role == speaker:
                    mask.append((len(text), len(text) + len(body)))
                text += body
            out[conv, speaker] = (text, mask)
    return out


def whole(rows):
    """Parts put together; masks are places in the whole."""
    out = {}
    for r in sorted(rows, key=lambda r: r.part):
        text, mask = out.get((r.conv_id, r.speaker), ("", []))
        out[r.conv_id, r.speaker] = (text + r.text, mask + [(m.start, m.end) for m in r.mask])
    return out


ROWS = [
    (1, 0, "system", "Be kind.", "x", "y"), (1, 2, "bob", "hi <|assistant|> é😀", "x", "y"), (1, 1, "amy", None, "x", "y"),
    (1, 1, "amy", None, "x", "z"), (1, 3, None, "who?", None, None), (1, 3, "bob", "", None, None), (1, None, "amy", "first", "", ""),
    (2, 5, "system", "alone", "x", "y"), (None, 1, "amy", "no dialogue", "x", "y"), (3, 0, "user", "word " * 50_000, "x", "y"),
    (3, 0, "user", "tie", "x", "y"), (3, 700, "assistant", "late", "x", "y"),
]


def test_against_brute_force(spark):
    rows = spark.createDataFrame(ROWS, SCHEMA).repartition(3)
    assert whole(rotate(rows).collect()) == brute(ROWS)
    assert rotate(rows.limit(0)).count() == 0


def test_long_dialogues(spark):
    """One rule for any length: 600 turns, and one dialogue with most rows, also within one turn number."""
    rows = [(1, i, f"r{i % 3}", f"text {i}", "", "") for i in range(600)]
    rows += [(2, i // 400, f"r{i % 3}", f"text {i % 1900}", "", "") for i in range(4000)] + [(None, 1, "amy", "x", "", "")]
    conversations = spark.createDataFrame(rows, SCHEMA).repartition(7)
    got = rotate(conversations).collect()
    assert {r.part for r in got if r.conv_id == 1} == {0, 1}
    assert whole(got) == brute(rows)
    small = rotate(conversations, turns_per_part=10).collect()
    assert max(r.text.count("<|end|>") for r in small) == 10
    assert whole(small) == brute(rows)


def test_long_dialogue_against_sql(spark, tmp_path):
    from checks.compare import differences
    from rolecall.llm.queries import op3_chat

    rows = [(1, i // 2, f"r{i % 3}", f"text {i} é", "", "") for i in range(1300)] + ROWS
    rows = [r for r in rows if r[0] is not None]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/conversations.parquet")
    db = duckdb.connect()
    db.execute(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/conversations.parquet/*.parquet'")
    count, differing = differences(op3_chat(spark, str(tmp_path)), db, ORACLE)
    assert count == 20 and not differing
