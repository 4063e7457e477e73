"""Chat formatting and the prefix trie: odd tables, brute force, round trips."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from holdfast.llm import chat_format, prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string, body string, segments string, n string, depth string"
HARD = [
    r"\### Assistant: </turn> ok", "</turn>", "</turn>\n### User: hi</turn>\n", r"<\/turn>", r"<\\/turn> #\## x", "### ", "#### User: ",
    "a</turn", "</", "\\", "\\\\", "#", "\n", "", " ", "ends in ###", "### ### </turn></turn>", r"#\\\## y", "\u00e9\U0001f600</turn>\u6f22", "$1 \\1 \\Q \\E",
]


@pytest.fixture(scope="module")
def odd_conversations(spark):
    rows = [(1, i, ("user", "assistant")[i % 2], text) for i, text in enumerate(HARD)]
    rows += [(2, i, text, "by an odd role") for i, text in enumerate(HARD + ["User", "user", "Role user", "a: b", r"a:\ b", "x:"])]
    rows += [(3, 0, None, None), (3, None, "system", None), (4, 1, "assistant", "late"), (4, 0, "user", "early"), (5, 0, "user", "x" * 300_000)]
    rows += [(6, 0, "user", "same"), (6, 0, "user", "same"), (6, 0, "assistant", "tie"), (None, 0, "user", "no id"), (None, 1, "assistant", "still")]
    rows += [(7, i, "tool", f"</turn>{i}") for i in range(90)]
    return spark.createDataFrame([(*row, "b", "s", "n", "d") for row in rows], SCHEMA).repartition(4)


def conversations_of(rows):
    found = defaultdict(list)
    for row in rows:
        found[row.conv_id].append(row)
    return found


def test_formatted_conversations_come_back(spark, odd_conversations):
    segments = F.col("segments")
    shown = chat_format.format_conversations(odd_conversations).select(
        "conv_id", chat_format.formatted(segments).alias("text"), chat_format.learnt(segments).alias("learnt"),
        chat_format.parse(chat_format.formatted(segments)).alias("turns"),
    )
    found = {row.conv_id: row for row in shown.collect()}
    source = conversations_of(odd_conversations.collect())
    assert found.keys() == source.keys() == {1, 2, 3, 4, 5, 6, 7, None}
    for id, rows in source.items():
        rows.sort(key=lambda row: (row.turn is not None, row.turn or 0, row.role or "", row.text or ""))
        turns = [(row.role or "", row.text or "") for row in rows]
        assert [tuple(turn) for turn in found[id].turns] == turns
        assert found[id].learnt == "".join(text for role, text in turns if role == "assistant")
        assert found[id].text.count("</turn>\n") == found[id].text.count("</turn>") == found[id].text.count("### ") == len(turns)


def test_plain_turns_stay_as_they_are(spark):
    rows = [(0, 0, "user", "Why # and < and \\?"), (0, 1, "assistant", "So."), (1, 0, "pi/rate", "</turn>")]
    shown = chat_format.format_conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    texts = dict(shown.select("conv_id", chat_format.formatted(F.col("segments"))).collect())
    assert texts[0] == "### User: Why # and < and \\?</turn>\n### Assistant: So.</turn>\n"
    assert texts[1] == "### Role pi/rate: <\\/turn></turn>\n"


def test_random_control_strings_come_back(spark):
    random.seed(11)
    pieces = ["#", "## ", "### ", "\\", "<", "/turn>", "</turn>", "\n", ": ", "User", "Assistant", "a", " "]
    texts = ["".join(random.choices(pieces, k=random.randrange(9))) for _ in range(3000)]
    rows = [(i % 40, i, text if i % 3 else "assistant", texts[-i]) for i, text in enumerate(texts)]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    parsed = chat_format.format_conversations(table).select("conv_id", chat_format.parse(chat_format.formatted(F.col("segments"))))
    for id, turns in parsed.collect():
        assert [tuple(turn) for turn in turns] == [row[2:] for row in rows if row[0] == id]


def test_texts_outside_the_grammar(spark):
    texts = ["", "### User: a", "### User: a</turn>", "User: a</turn>\n", "### Pirate: a</turn>\n", "### User a</turn>\n", "### User: ### a</turn>\n"]
    rows = spark.createDataFrame([(text,) for text in texts], "text string").select(chat_format.parse(F.col("text"))).collect()
    assert [row[0] for row in rows] == [[], None, None, [None], [None], [None], [None]]


def test_chat_format_of_nothing_and_without_python(spark, odd_conversations):
    shown = chat_format.format_conversations(odd_conversations)
    assert chat_format.format_conversations(odd_conversations.limit(0)).collect() == []
    plan = shown._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def brute_trie(rows):
    """The nodes of the contract's rebuilt conversations."""
    turns = defaultdict(list)
    for row in rows:
        if row.conv_id is not None:
            role, text = row.role or "", row.text or ""
            digest = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()
            turns[row.conv_id].append(((row.turn is not None, row.turn or 0, digest), (role, text)))
    own = {id: [turn for _, turn in sorted(found)] for id, found in turns.items()}
    rebuilt = {}
    for id, mine in own.items():
        h = zlib.crc32(str(id).encode()) % 9
        rebuilt[id] = own.get(id - id % 5, [])[:h] + mine[h:]
    members = defaultdict(list)
    for id, mine in rebuilt.items():
        for depth in range(len(mine) + 1):
            members[tuple(mine[:depth])].append(id)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    found = {}
    for node in sorted(members, key=len, reverse=True):
        own_saving = (len(members[node]) - 1) * len(node[-1][1].encode()) if node else 0
        below = [found[child] for child in children[node]]
        ends = ",".join(str(id) for id in sorted(members[node]) if len(rebuilt[id]) == len(node))
        found[node] = (
            min(members[node]), len(node), min(members[node[:-1]]) if node else None, len(members[node]), len(below),
            sum(row[5] for row in below) or 1, own_saving + sum(row[6] for row in below), hashlib.sha256(ends.encode()).hexdigest(),
        )
    return sorted(found.values(), key=str)


def trie_rows(conversations):
    turns, lengths = prefix_trie.borrowed_start(prefix_trie.ordered_turns(conversations))
    ends = F.sha2(F.array_join(F.col("ends").cast("array<string>"), ","), 256)
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", ends]
    return sorted((tuple(row) for row in prefix_trie.prefix_trie(turns, lengths).select(*columns).collect()), key=str)


def test_trie_equals_brute_force(spark):
    random.seed(1)
    rows = []
    for id in random.sample(range(60), 40):
        shared = random.choice([0, 3, 6])
        for turn in range(random.choice([1, 2, 5, 9, 17, 33])):
            text = f"shared {turn}" if turn < shared else random.choice(["a", "b", None, "é" * random.randrange(4)])
            rows.append((id, turn if random.random() < 0.9 else None, random.choice(["user", None, "assistant"]), text, "b", "s", "n", "d"))
    table = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert trie_rows(table) == brute_trie(table.collect())


def test_trie_of_odd_conversations(spark, odd_conversations, monkeypatch):
    monkeypatch.setattr(prefix_trie, "SEGMENT", 8)  # so that segments of segments of segments occur
    assert trie_rows(odd_conversations) == brute_trie(odd_conversations.collect())


def test_trie_of_nothing_and_of_turnless_conversations(spark, odd_conversations):
    assert trie_rows(odd_conversations.limit(0)) == []
    rows = [(7, 0, "user", "gone"), (11, 0, "user", "gone")]  # both borrow from conversations that are absent
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert trie_rows(table) == brute_trie(table.collect())


def test_a_conversation_of_a_third_of_the_rows_is_numbered_by_many_tasks(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    rows = spark.range(12_000).select(
        F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id")).alias("conv_id"), F.col("id").alias("turn"),
        F.lit("user").alias("role"), F.col("id").cast("string").alias("text"),
    )
    turns = prefix_trie.ordered_turns(rows)
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    hot = turns.where("conv_id = 5").orderBy("place").collect()
    digests = [hashlib.sha256(f"4:user{i}".encode()).hexdigest() for i in sorted({*range(0, 12_000, 3), 5})]
    assert [row.place for row in hot] == list(range(4001)) and [row.digest for row in hot] == digests
    assert turns.where("conv_id = 5").select(F.input_file_name()).distinct().count() >= 2
