import duckdb
import pyarrow as pa

from factloom.llm import chat


def run(spark, rows):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, place string, branch int")
    return {(r.conv_id, r.turn): r for r in chat.conversations(df).collect()}


def row(conv, turn, text):
    return (conv, turn, "user", text, "x", 1)


def test_links_branches_and_clean_text(spark):
    got = run(spark, [
        row(1, 0, "First question here"),
        row(1, 1, "An answer\nwith two lines"),
        row(1, 2, "Ann wrote:\n> first   QUESTION here\n\nMy reply to the first"),
        row(1, 3, "goes on"),
        row(1, 4, "> with two lines\n>> First question here\nagain"),
        row(1, 5, "> nobody said this\nplain"),
        row(2, 0, "> First question here\nother conversation"),
        row(2, 1, None),
        row(4, 0, "root line"),
        row(4, 1, "between"),
        row(4, 2, ">> root line\n> not said\nthree"),
        row(4, 3, "> between\n>> root line\n>> three\nthe outer level counts"),
    ])
    assert got[4, 2].reply_to == 0 and got[4, 3].reply_to == 1
    assert {k[1]: r.reply_to for k, r in got.items() if k[0] == 1} == {0: None, 1: 0, 2: 0, 3: 2, 4: 1, 5: 4}
    assert {k[1]: r.branch for k, r in got.items() if k[0] == 1} == {0: 0, 1: 0, 2: 2, 3: 2, 4: 4, 5: 4}
    assert got[1, 2].text == "My reply to the first" and got[1, 4].text == "again" and got[1, 4].depth == 2 and got[1, 4].n_quoted == 2
    order = [k[1] for k, r in sorted(got.items(), key=lambda x: (x[0][0], tuple(x[1].place))) if k[0] == 1]
    assert order == [0, 1, 2, 3, 4, 5]
    assert got[2, 0].reply_to is None and got[2, 1].text == "" and got[2, 1].reply_to == 0


def test_votes_ties_and_blocks(spark):
    rows = [row(1, 0, "alpha line\nbeta line"), row(1, 1, "alpha line"), row(1, 2, "> alpha line\n> beta line\nx")]
    assert run(spark, rows)[1, 2].reply_to == 1  # one line each: the later message
    long = [row(7, k, f"message {k}") for k in range(0, 3000, 7)] + [row(7, 3001, "> message 14\nback")]
    got = run(spark, long)
    assert got[7, 3001].reply_to == 14 and got[7, 3001].place["from"] == 14
    turns = sorted(k for _, k in got)
    assert all(got[7, t].reply_to == (turns[i - 1] if i else None) for i, t in enumerate(turns[:-1]))
    assert all(got[7, t].branch == 0 for t in turns[:-1])


def test_nulls_repeats_and_empty(spark):
    got = run(spark, [row(None, 0, "a b"), row(None, 1, "> a b"), row(3, None, "last"), row(3, 0, "first")])
    assert got[None, 1].reply_to == 0 and got[None, 1].text == "" and got[3, None].reply_to == 0
    df = spark.createDataFrame([row(1, 0, "a"), row(1, 0, "a"), row(1, 1, "b")], "conv_id long, turn long, role string, text string, place string, branch int")
    assert chat.conversations(df).count() == 3
    assert chat.conversations(df.limit(0)).count() == 0


def test_a_common_line_in_a_long_conversation(spark):
    """The last own line before each quotation, by brute force, within a block and across several."""
    said = {k for k in range(0, 5000, 3) if not 900 < k < 4000}
    asks = {k for k in range(5, 5000, 35)}
    rows = [row(1, k, ("Yes\n" if k in said else "") + ("> yes\n" if k in asks else "") + f"message {k}") for k in range(5000)]
    got = run(spark, rows)
    for k in range(1, 5000):
        assert got[1, k].reply_to == (max(s for s in said if s < k) if k in asks else k - 1)


def test_sql_gives_the_same_rows(spark, tmp_path, rng):
    """The query against its SQL over random conversations with quotations of several levels, null and sparse turns, and repeated rows."""
    said = ["yes", "No", "what is it", "Ünï É", "fine  then", "", " \t", "Ann wrote:", "x a écrit :", "> odd", "a\u2028b ", "he said: no", "wrote:"]
    rows = []
    for conv in (1, 2, None, 3):
        turns = sorted(rng.sample(range(100_000), 60)) if conv != 2 else list(range(60))
        for t in turns:
            lines = [">" * rng.choice((0, 0, 1, 2, 3)) + rng.choice(("", " ")) + rng.choice(said) for _ in range(rng.randint(0, 6))]
            rows.append(row(conv, t, None if rng.random() < 0.03 else rng.choice(("\n", "\r\n")).join(lines)))
    rows += [row(3, None, "> yes\nlast"), row(3, None, "yes"), rows[5], rows[5]]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, place string, branch int").repartition(5)
    df.write.parquet(str(tmp_path / "conversations.parquet"))
    got = chat.query(spark, str(tmp_path)).toPandas()
    con = duckdb.connect()
    con.register("conversations", pa.table(df.toArrow()))
    want = con.execute(chat.ORACLE_SQL).df()
    key = sorted(want.columns)
    listed = lambda d: sorted(map(str, d[key].astype(object).where(d[key].notna(), None).map(lambda v: int(v) if isinstance(v, float) else v).values.tolist()))
    assert listed(got) == listed(want)
    assert got["reply_to"].notna().sum() > 200


def test_long_message_and_empty_table(spark, tmp_path):
    schema = "conv_id long, turn long, role string, text string"
    spark.createDataFrame([(1, 0, "u", "line\n" * 50_000 + "root"), (1, 1, "u", "> root\n" * 20_000 + "end")], schema).write.parquet(str(tmp_path / "a" / "conversations.parquet"))
    got = {r.turn: r for r in chat.query(spark, str(tmp_path / "a")).collect()}
    assert got[1].reply_to == 0 and got[1].n_quoted == 20_000 and got[0].own_chars == 250_004
    spark.createDataFrame([], schema).write.parquet(str(tmp_path / "b" / "conversations.parquet"))
    assert chat.query(spark, str(tmp_path / "b")).count() == 0
