"""op8 and op9: SQL, exact round trips, and awkward tables."""

import gzip
import io
import random

import llm_cases as C
import pytest
from oracle_harness import compare, duck

from tagloom.llm import chat, oracle, queries, warc
from tagloom.session import scratch_table_path


@pytest.mark.parametrize("name", ["op8_warc_round_trip", "op9_prefix_target_chat"])
def test_query_equals_sql(spark, name):
    r = compare(spark, duck(C.SF), name, queries.QUERIES[name], oracle.ORACLE_SQL[name], C.SF)
    assert r["cols_match"] and r["values_match"], r


PAGES = [(3, "u3", "<p>same"), (1, "u1", "<p>same"), (1, "u1", "<p>same"), (2, None, None), (5, "u\r\nX: y", ""), (None, "n", "<p>same"),
         (None, "m", "alone"), (6, "six", "\r\n\r\nWARC/1.1\r\n\x00é")]


def pages(spark, rows=PAGES):
    return spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr(
        "*", "'x' AS sha", "1 AS size", "'y' AS first", "'z' AS value")


def test_warc_awkward_rows(spark):
    path = scratch_table_path(spark, "warc-test")
    warc.write_archives(pages(spark), path)
    index = warc.index(spark, path)
    got = warc.read_records(index, payloads=True).collect()
    assert len(got) == len(PAGES) and index.count() == len(PAGES)
    assert sorted((str(r.page_id), r.record_type, r.refers_to) for r in got) == sorted([
        ("3", "revisit", 1), ("1", "response", None), ("1", "response", None), ("2", "response", None), ("5", "revisit", 2),
        ("None", "revisit", 1), ("None", "response", None), ("6", "response", None)])
    six = next(r for r in got if r.page_id == 6)
    assert bytes(six.payload) == PAGES[-1][2].encode() and six.url == "six"
    assert {r.payload_digest for r in got if r.page_id in (1, 3)} == {warc.payload_digest(b"<p>same")}
    # a selection reads only its own records
    assert [r.page_id for r in warc.read_records(index.where("page_id = 6")).collect()] == [6]
    assert warc.round_trip(pages(spark).limit(0)).count() == 0
    assert {r.record_type for r in warc.round_trip(pages(spark), min_bytes=8).collect()} == {"response"}


def test_archive_is_gzip_members_one_per_record():
    raws = [warc.record(i, f"u{i}", (b"x%d" % i) * (100 * i), None if i % 2 else 7) for i in range(6)]
    data = b"".join(warc.member(r) + b"\0" for r in raws)
    assert gzip.decompress(data) == b"".join(raws)
    places = list(warc.scan(io.BytesIO(data)))
    assert [gzip.decompress(data[o : o + n]) for o, n, _ in places] == raws
    assert [warc.headers(h)[0]["warc-record-id"] for _, _, h in places] == [f"<urn:x-page:{i}>" for i in range(6)]


def test_archive_with_a_record_over_16_mb():
    big = warc.record(1, "u", random.Random(0).randbytes(1 << 10) * (17 << 10), None)
    data = warc.member(big) + b"\0" + warc.member(warc.record(2, "v", b"small", None)) + b"\0"
    (a, n, _), (b, m, _) = warc.scan(io.BytesIO(data))
    assert gzip.decompress(data[a : a + n]) == big and a + n == b and b + m == len(data)


def test_ranges_merge_neighbours():
    got = list(warc.ranges([(0, 10), (10, 10), (20 + warc.READ_GAP, 5), (26 + 2 * warc.READ_GAP, 5), (10**9, warc.READ_BYTES + 1)]))
    assert got == [[(0, 10), (10, 10), (20 + warc.READ_GAP, 5)], [(26 + 2 * warc.READ_GAP, 5)], [(10**9, warc.READ_BYTES + 1)]]


def test_escape_is_reversible():
    r = random.Random(1)
    for _ in range(20000):
        t = "".join(r.choice(["<", "|", "\\", "im_end", ">", "n", "\n", "a", "<|im_start|>"]) for _ in range(r.randrange(10)))
        e = chat.escape(t)
        assert "<|" not in e and chat.unescape(e) == t
        formatted, a, b = chat.segment(t, t[::-1])
        assert chat.parse_segment(formatted) == (t, t[::-1]) and chat.unescape(formatted[a:b]) == t[::-1]


TURNS = [(1, 1, "assistant", "A1"), (1, 0, "user", "q<|im_end|>"), (1, 2, "user", None), (1, 3, "assistant", "A2<|im_start|>"), (None, 0, "user", "n"),
         (2, None, None, "x"), (2, 0, "assistant", ""), (3, 5, "assistant", "t"), (3, 5, "assistant", "t")]


def turns(spark, rows=TURNS):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "'x' AS n", "'y' AS segment", "'z' AS start")


def test_chat_awkward_rows(spark):
    got = {r.conv_id: r for r in chat.round_trip(turns(spark)).collect()}
    assert {i: (r.n_turns, r.loss_chars) for i, r in got.items()} == {1: (4, 2 + 2 + len("<|im_start|>")), None: (1, 0), 2: (2, 0), 3: (2, 2)}
    assert chat.round_trip(turns(spark).limit(0)).count() == 0


def test_every_reply_is_an_example_with_all_turns_before_it(spark):
    formatted = chat.segments(turns(spark))
    refs = chat.examples(formatted).collect()
    texts = chat.example_texts(formatted).collect()
    assert len(refs) == len(texts) == 5
    whole = {}
    for r in sorted(formatted.collect(), key=lambda r: (str(r.conv_id), r.n)):
        assert r.start == len(whole.get(r.conv_id, ""))
        whole[r.conv_id] = whole.get(r.conv_id, "") + r.segment
    by = {(r.conv_id, r.turn_index): r for r in texts}
    for r in refs:
        t, text = by[r.conv_id, r.turn_index], whole[r.conv_id]
        assert t.context == text[: r.context_end] and t.target == text[r.target_start : r.target_end]
        assert t.context.endswith("<|im_start|>assistant\n") and t.rest == "<|im_end|>\n"
    assert [chat.unescape(by[1, k].target) for k in (1, 3)] == ["A1", "A2<|im_start|>"]


def test_a_long_conversation_streams(spark):
    rows = [(1, k, "assistant" if k % 2 else "user", f"text {k} " * 20) for k in range(4000)]
    r = chat.round_trip(turns(spark, rows)).first()
    assert r.n_turns == 4000 and r.loss_chars == sum(len(t) for _, k, _, t in rows if k % 2)


def test_the_query_makes_and_reads_every_example(spark, monkeypatch):
    made, own = [], chat.examples
    monkeypatch.setattr(chat, "examples", lambda formatted: made.append(own(formatted)) or made[-1])
    queries.op9_prefix_target_chat(spark, C.SF)
    replies = sum(role == "assistant" for role, in C.read("conversations", ["role"])) + 1  # one in the control conversation
    assert len(made) == 1 and made[0].count() == replies


def test_loss_comes_from_examples_and_contexts_are_checked(spark):
    formatted = chat.segments(turns(spark))
    found = chat.examples(formatted)
    part = {r.conv_id: r for r in chat.read_back(formatted, found.where("turn_index != 3")).collect()}
    assert (part[1].n_turns, part[1].loss_chars) == (4, 2) and part[3].loss_chars == 2
    for wrong in (formatted.selectExpr("conv_id", "n", "replace(segment, 'q', 'r') AS segment", "start"), formatted.where("n != 1")):
        with pytest.raises(Exception, match="is not in the segments"):
            chat.read_back(wrong, found).collect()


def test_examples_are_written_out_and_read_back_from_their_texts(spark, monkeypatch):
    made, real = {}, chat.read_back
    monkeypatch.setattr(chat, "read_back", lambda formatted, found: made.update(chat=formatted, examples=found) or real(formatted, found))
    chat.round_trip(turns(spark)).collect()
    assert "examples-" in made["examples"].inputFiles()[0]
    segments = {(r.conv_id, r.n): r.segment for r in made["chat"].collect()}
    texts = made["examples"].collect()
    assert len(texts) == 5
    for r in texts:
        whole = "".join(segments[r.conv_id, n] for n in range(r.turn_index + 1))
        assert r.context + r.target + r.rest == whole and len(r.context) == r.target_start
    found = made["examples"]
    for wrong in (found.selectExpr("* EXCEPT (context)", "context || 'x' AS context"), found.selectExpr("* EXCEPT (target)", "target || 'x' AS target"),
                  found.selectExpr("* EXCEPT (rest)", "'' AS rest")):
        with pytest.raises(Exception, match="is not in the segments"):
            real(made["chat"], wrong).collect()
