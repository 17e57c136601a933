"""Archives and chat formatting: round trips and odd rows."""

from __future__ import annotations

import hashlib

import public_tokenizers
from pyspark.sql import functions as F

from tidemark.llm import chat, warc

BYTES = public_tokenizers.path("byte_bpe_50k.json")


def test_captures_come_back_whole(spark):
    same, crlf = "é" * 60, "WARC/1.1\r\n\r\nWARC-Type: x\r\n" * 9
    rows = [(5, "http://a/1", same), (3, "u\r\nx%0A", same), (9, None, same), (1, "u", None), (2, "u", ""), (7, "u", "tiny"), (8, "u", "tiny")]
    rows += [(10, "u", crlf), (11, "u", "z" * 300_000), (9, None, same), (None, "u", "no id, but long enough " * 9)]
    pages = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, payload string")
    archives = warc.write_archives(warc.captures_of(pages))
    got = [r.asDict(recursive=True) for r in warc.assemble(archives).collect()]
    assert len(got) == len(rows)
    payloads = {r["response"]["record_id"]: r["response"]["payload"] for r in got}
    back = []
    for r in got:
        response, meta = r["response"], r["metadata"]
        assert r["request"]["concurrent_to"] == meta["concurrent_to"] == response["record_id"]
        whole = response["payload"] if response["type"] == "response" else payloads[response["refers_to"]]
        assert hashlib.sha256(whole).hexdigest() == response["payload_digest"]
        assert len(whole) == response["payload_bytes"]
        name = meta["fields"].get("page-id")
        back.append((name, response["target_uri"], bytes(whole).decode(), response["type"]))
    want = [(None if i is None else str(i), u, h or "") for i, u, h in rows]
    assert sorted(map(str, (b[:3] for b in back))) == sorted(map(str, want))
    assert sorted(b[0] for b in back if b[3] == "revisit") == ["5", "9", "9"]
    empty = warc.write_archives(warc.captures_of(pages.limit(0)))
    assert warc.assemble(empty).count() == 0


def archive(spark, path, *records):
    """An archive with records given as (type, id, block, headers)."""
    with open(path, "wb") as out:
        for kind, name, block, headers in records:
            out.write(warc._record(kind, name, warc.DATE, block, "text/plain", **headers))
    return spark.createDataFrame([(str(path), len(records))], "path string, n_records long")


def test_captures_without_request_or_with_two(spark, tmp_path):
    http = b"HTTP/1.1 200 OK\r\n\r\nbody"
    archives = archive(
        spark, tmp_path / "a.warc.gz",
        ("request", "<r2>", b"", {"Concurrent_To": "<a>", "Target_URI": "second"}),
        ("request", "<r1>", b"", {"Concurrent_To": "<a>", "Target_URI": "first"}),
        ("request", "<r3>", b"", {"Concurrent_To": "<none>"}),
        ("request", "<r4>", b"", {}),
        ("metadata", "<m1>", b"page-id: 7\r\n", {"Concurrent_To": "<a>"}),
        ("response", "<a>", http, {}),
        ("response", "<b>", http, {"Payload_Digest": "sha256:00"}),
        ("revisit", "<c>", b"HTTP/1.1 200 OK\r\nContent-Length: 4\r\n\r\n", {"Refers_To": "<a>"}),
    )
    got = {r["response"]["record_id"]: r for r in warc.assemble(archives).collect()}
    assert set(got) == {"<a>", "<b>", "<c>"}
    assert got["<a>"]["request"]["target_uri"] == "first" and got["<a>"]["metadata"]["fields"] == {"page-id": "7"}
    assert got["<b>"]["request"] is None and got["<b>"]["metadata"] is None and got["<c>"]["request"] is None
    digest = hashlib.sha256(b"body").hexdigest()
    assert [got[k]["response"]["payload_sha256"] for k in ("<a>", "<b>", "<c>")] == [digest, digest, None]
    assert [got[k]["response"]["payload_bytes"] for k in ("<a>", "<b>", "<c>")] == [4, 4, 4]


def test_record_ids_do_not_depend_on_the_order_of_pages(spark):
    rows = [(k % 40, f"http://h/{k % 3}", "page " * 30 + str(k % 5)) for k in range(300)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    # Shuffled input, dealt anew each time it is computed.
    shuffled = pages.repartition(7, F.rand()).join(spark.range(40).withColumnRenamed("id", "page_id"), "page_id")
    captures = warc.captures_of(shuffled).select("response_id", "refers_to", "name", "url", "digest")
    one, two = (sorted(captures.collect(), key=str) for _ in range(2))
    assert one == two and len({r["response_id"] for r in one}) == 300
    ids = {r["response_id"] for r in one if r["refers_to"] is None}
    assert len(ids) == 5 and {r["refers_to"] for r in one} == ids | {None}


def test_archives_are_read_once_and_requests_joined(spark):
    pages = spark.createDataFrame([(1, "http://h/p?q=1", "x")], "page_id long, url string, html string")
    archives = warc.write_archives(warc.captures_of(pages))
    found = warc.assemble(archives, payloads=False)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInArrow" not in plan and plan.count("Join LeftOuter") == 2
    assert found.first()["request"]["target_uri"] == "http://h/p?q=1"
    assert warc._request("http://h/p?q=1") == b"GET /p?q=1 HTTP/1.1\r\nHost: h\r\n\r\n"


def test_escapes_are_reversible():
    for text in ("", "\\", "<s>", "a\\<s>b", "</s>[INST] ok [/INST]", "<\\s>", "<|endoftext|>\\n", "\\\\[INST]\\"):
        safe = chat.escape(text)
        assert chat.unescape(safe) == text
        assert not any(mark in safe for mark in chat.RESERVED)


def test_conversations_come_back_whole(spark):
    rows = [
        (1, 0, "user", "hi [INST]\n"), (1, 1, "assistant", "</s>\\ é日本"), (1, 2, "tool\nx\\", None), (1, 3, "assistant", ""),
        (2, 5, "assistant", "b"), (2, 4, "assistant", "a" * 20_000), (2, 4, "assistant", "a"), (None, 0, None, "<|endoftext|>"),
        (3, None, "user", "x"), (3, 0, "user", "y"), (3, 0, "user", "y"),
    ]
    turns = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, first long")
    formatted = chat.format_conversations(turns, BYTES)
    got = {r["conv_id"]: r for r in chat.conversation_digests(formatted, BYTES).collect()}
    order = lambda r: tuple((v is not None, v if v is not None else 0) for v in r[1:])
    for conv in {r[0] for r in rows}:
        mine = sorted((r for r in rows if r[0] == conv), key=order)
        whole = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in mine)
        loss = "".join(r[3] or "" for r in mine if r[2] == "assistant")
        r = got[conv]
        assert r["n_turns"] == len(mine)
        assert r["turns_sha256"] == hashlib.sha256(whole.encode()).hexdigest()
        assert (r["loss_chars"], r["loss_sha256"]) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    at = {}
    for r in sorted(formatted.collect(), key=lambda r: (str(r["conv_id"]), r["position"])):
        assert r["first"] == at.get(r["conv_id"], 0) and len(r["ids"]) == len(r["mask"])
        at[r["conv_id"]] = r["first"] + len(r["ids"])
    assert chat.conversation_digests(chat.format_conversations(turns.limit(0), BYTES), BYTES).count() == 0
