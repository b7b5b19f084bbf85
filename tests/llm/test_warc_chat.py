import hashlib
import itertools
import re
import struct

import pyarrow.fs
import pytest

from sparkroute.llm.chat_repair import INSERT, LEGAL, MERGE, RELABEL, START, STATE_OF, UNKNOWN, end_cost, matrix, repaired
from sparkroute.llm.warc_archive import SKIPPABLE, archive_bytes, read_archives, read_records, record_bytes, write_archives


def test_round_trip_and_revisits(spark):
    long_a, long_b = "<p>" + "a" * 1200, "ü" * 600
    rows = [(1, "http://x/ %20\r\n", long_a), (2, None, long_a), (9, "u", long_a), (3, "u", long_b), (4, "u", "short"), (5, "u", "short"),
            (6, "u", None), (7, "u", ""), (None, "u", long_b), (8, "u", "z" * 3_000_000)]
    pages = spark.createDataFrame([(*r, "e") for r in rows], "page_id long, url string, html string, error string")
    got = read_archives(spark, write_archives(pages)).collect()
    assert len(got) == 10 and all(r["error"] is None for r in got)
    by_id = {r["page_id"]: r for r in got}
    for i, url, html in rows:
        data = (html or "").encode()
        r = by_id[i]
        assert (r["payload_bytes"], r["payload_digest"], r["url"]) == (len(data), hashlib.sha1(data).hexdigest(), url)
        assert r["payload"] is None if r["record_type"] == "revisit" else bytes(r["payload"]) == data
    assert {i: r["refers_to"] for i, r in by_id.items() if r["record_type"] == "revisit"} == {1: 9, 2: 9, None: 3}
    assert read_archives(spark, write_archives(pages.limit(0))).count() == 0


def test_every_record_is_a_frame_and_damage_is_reported():
    records = [record_bytes(i, f"u{i}", b"payload %d " % i * 50, None, False) for i in range(40)]
    data = archive_bytes(records)
    magic, size = struct.unpack_from("<II", data)
    assert magic == SKIPPABLE and data[8 + size :].count(b"\x28\xb5\x2f\xfd") >= 40
    rows = list(read_records(data))
    assert [r[0] for r in rows] == list(range(40)) and all(r[-1] is None for r in rows)
    broken = bytearray(data)
    broken[-30] ^= 255
    rows = list(read_records(bytes(broken)))
    assert len(rows) == 40 and rows[-1][-1] and all(r[-1] is None for r in rows[:-1])
    assert list(read_records(data[8 + size :]))[0][-1].startswith("archive")
    short = records[0].replace(b"Content-Length: ", b"Content-Length: 9", 1)
    good = list(read_records(archive_bytes([short, records[1]])))
    assert good[0][-1] and good[1][-1] is None


def test_a_given_folder(spark, tmp_path):
    pages = spark.createDataFrame([(1, "u", "x")], "page_id long, url string, html string")
    folder = write_archives(pages, folder=f"file://{tmp_path}/archives")
    assert read_archives(spark, folder).count() == 1
    names = [f.path for f in pyarrow.fs.LocalFileSystem().get_file_info(pyarrow.fs.FileSelector(f"{tmp_path}/archives"))]
    assert sum(n.endswith(".warc.zst") for n in names) == 1


def cheapest(roles):
    """Least cost over all merges, labels and insertions, by search over legal sequences."""
    import heapq

    heap, seen = [(0, 0, START)], set()
    while heap:
        cost, i, state = heapq.heappop(heap)
        if (i, state) in seen:
            continue
        seen.add((i, state))
        if i == len(roles) and state == STATE_OF["assistant"]:
            return cost
        for to in LEGAL[state]:
            heapq.heappush(heap, (cost + INSERT, i, to))
            if i < len(roles):
                own = STATE_OF.get(roles[i])
                heapq.heappush(heap, (cost + (0 if own == to else UNKNOWN if own is None else RELABEL), i + 1, to))
        if i < len(roles) and state != START:
            own = STATE_OF.get(roles[i])
            heapq.heappush(heap, (cost + MERGE + (0 if own == state else UNKNOWN if own is None else RELABEL), i + 1, state))


@pytest.mark.parametrize("n", [1, 2, 3, 4])
def test_cost_is_least(n):
    for roles in itertools.product(["system", "user", "assistant", "tool"], repeat=n):
        m = matrix(list(roles))[START]
        assert min(m[s] + end_cost(s) for s in (1, 2, 3)) == cheapest(roles)


def legal(roles):
    roles = roles[1:] if roles[:1] == ["system"] else roles
    return bool(roles) and len(roles) % 2 == 0 and roles == ["user", "assistant"] * (len(roles) // 2)


def test_repaired_dialogues_are_legal_and_keep_all_text(spark):
    rows = [(1, 0, "user", "a"), (1, 1, "user", "b"), (1, 2, "assistant", "c"), (2, 0, "assistant", "d"), (3, None, None, None),
            (3, 1, "USER ", "e"), (None, 0, "tool", "f"), (4, 0, "system", "g"), (4, 0, "system", "g"), (5, 1, "user", "h" * 100_000)]
    rows += [(6, t, "user" if t % 3 else "assistant", f"t{t}") for t in range(1000)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, block int")
    got = {}
    for r in sorted(repaired(df).collect(), key=lambda r: (str(r["conv_id"]), r["block"], r["place"])):
        got.setdefault(r["conv_id"], []).append(r)
    assert set(got) == {1, 2, 3, 4, 5, 6, None}
    for conv, turns in got.items():
        dialogue = "".join(t["rendered"] for t in turns)
        roles = [p.split("\n")[0] for p in dialogue.split("<|im_start|>")[1:]]
        assert legal(roles) and dialogue.count("<|im_end|>\n") == len(roles)
        for _, _, _, text in (r for r in rows if r[0] == conv):
            assert (text or "") in dialogue
    assert [t["text"] for t in got[1]] == ["a\nb", "c"]
    assert repaired(df.limit(0)).count() == 0


def dialogues(rows):
    """The rows of each conversation in order."""
    got = {}
    for r in sorted(rows, key=lambda r: (r["block"], r["place"])):
        got.setdefault(r["conv_id"], []).append(r)
    return got


def test_turns_of_equal_or_no_number_are_cut_in_blocks_too(spark):
    rows = [(None, 0, "user" if i % 3 else "assistant", f"n{i:04}") for i in range(600)] + [(None, None, None, None)] * 700
    rows += [(7, None, "tool", f"s{i:04}") for i in range(300)] + [(8, 1 << 40, "user", "far"), (8, -5, "system", "near")]
    got = dialogues(repaired(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect())
    for conv, n in ((None, 1300), (7, 300), (8, 2)):
        sources = {}
        for r in got[conv]:
            sources[r["block"]] = sources.get(r["block"], 0) + sum(e != "insert" for e in r["edits"].split(","))
        assert sum(sources.values()) == n and max(sources.values()) <= 256 and sorted(sources) == list(range(-(-n // 256)))
        dialogue = "".join(r["rendered"] for r in got[conv])
        assert legal([p.split("\n")[0] for p in dialogue.split("<|im_start|>")[1:]])
    # nulls first, then by role and text
    texts = "".join(r["rendered"] for r in got[None])
    order = [f"n{i:04}" for i in range(0, 600, 3)] + [f"n{i:04}" for i in range(600) if i % 3]
    assert re.findall(r"n\d{4}", texts) == order


def test_blocks_in_a_tree_cost_the_least(spark, monkeypatch):
    import random

    from sparkroute.llm import chat_repair

    monkeypatch.setattr(chat_repair, "BLOCK_TURNS", 4)
    monkeypatch.setattr(chat_repair, "FAN", 3)
    rnd = random.Random(3)
    convs = {c: [rnd.choice(["system", "user", "assistant", "tool", None]) for _ in range(n)] for c, n in ((1, 200), (2, 37), (None, 113), (3, 3))}
    rows = [(c, t, role, f"{t},") for c, roles in convs.items() for t, role in enumerate(roles)]
    rnd.shuffle(rows)
    got = dialogues(repaired(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect())
    assert set(got) == set(convs)
    for conv, roles in convs.items():
        cost, i = 0, 0
        for r in got[conv]:
            for edit in r["edits"].split(","):
                if edit == "insert":
                    cost += INSERT
                    continue
                own, to = STATE_OF.get(roles[i]), STATE_OF[r["role"]]
                cost += (MERGE if edit == "merge" else 0) + (0 if own == to else UNKNOWN if own is None else RELABEL)
                i += 1
        assert i == len(roles) and cost == cheapest(roles)
        assert "".join(r["text"] for r in got[conv]).replace("\n", "") == "".join(f"{t}," for t in range(len(roles)))
