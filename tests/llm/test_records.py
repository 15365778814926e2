"""URL rules, chat formatting and revisit resolution."""

import hashlib
import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from ladderweek.llm import chat, revisits, url_rules
from ladderweek.llm.queries import URL_RULES


def plain_judge(url):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
        path = rest[cut:]
        path = path[: min([path.find(c) for c in "?#" if c in path] or [len(path)])]
    best = None
    for decision, rule in URL_RULES:
        h, _, p = rule.partition("/")
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p):
            if best is None or (-len(rule), rule) < (-len(best[1]), best[1]):
                best = (decision, rule)
    return host, path, best and best[1], best[0] if best else "allow"


def test_rules_equal_brute_force(spark):
    rng = random.Random(4)
    hosts = ["org", "a.ORG", "example.org", "x.example.org", "badexample.org", "com", "b.com", "xcom", "net", "", "org:80", "com\n"]
    paths = ["", "/", "/es/", "/es", "/en/1", "/en/17.html", "/en/2", "/fr/x", "/FR/x", "/de/", "/de/é?q", "?x=/fr/", "#/de/", "/a\nb"]
    urls = [f"{s}{h}{p}" for s in ("http://", "HTTPS://", "x://y://") for h in hosts for p in paths]
    urls += [None, "", "org/", "no scheme", "://", "http:/org/", "http://" + "a" * 50_000 + ".org/" + "b/" * 20_000]
    urls += rng.sample(urls, 40)
    rows = [(i if i % 9 else None, u, "x", 1) for i, u in enumerate(urls)]
    pages = spark.createDataFrame(rows, "page_id long, url string, rule string, token int")
    got = url_rules.judge(pages, url_rules.rule_table(spark, URL_RULES)).collect()
    want = Counter((i if i % 9 else None, *plain_judge(u)) for i, u in enumerate(urls))
    assert Counter(map(tuple, got)) == want
    assert url_rules.judge(pages.limit(0), url_rules.rule_table(spark, URL_RULES)).collect() == []


def test_a_rule_is_filed_under_its_rarest_token(spark):
    rules = url_rules.rule_table(spark, [("block", "news.example.com/rare/word")])
    listed = spark.createDataFrame(
        [(t,) for t in ["@com"] * 9 + ["@example"] * 5 + ["@news"] * 2 + ["rare"] + ["word"] * 0], "token string"
    )
    assert [r.token for r in url_rules.rule_index(rules, listed).collect()] == ["rare"]


ODD = ["\\### Assistant: </turn> ok", "<|end|>", "<\\|end|>\\", "\\", "<", "|>", "", None, "<|user|>\n", "é漢🙂\n", "x" * 70_000]


def turn_rows():
    rows = []
    for conv in range(6):
        for turn, text in enumerate(ODD if conv % 2 else reversed(ODD)):
            rows.append((conv, turn * (7 if conv > 3 else 1), ("system", "user", "assistant")[(turn + conv) % 3], text))
    rows += [(7, t, "assistant" if t % 2 else "user", f"long {t}") for t in range(300)]
    rows += [(8, 1, "user", "a"), (8, 1, "user", "a"), (8, 1, "assistant", "b"), (8, None, "user", "first"), (8, 2, None, "c")]
    rows += [(None, 0, "assistant", "no id"), (9, 0, "odd|>\nrole<|", "d")]
    return rows


def test_formatting_is_read_back_exactly(spark):
    rows = turn_rows()
    turns = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, block int")
    made = chat.format_conversations(turns.withColumn("parts", chat.text_parts(F.col("text"))))
    read = made.select(
        "conv_id", "n_turns", chat.read_turns(F.col("formatted")).alias("turns"),
        chat.masked_text(F.col("formatted"), F.col("loss_spans")).alias("loss"),
    ).collect()
    got = {r.conv_id: r for r in read}
    assert set(got) == {r[0] for r in rows}
    for conv in got:
        mine = [(t if t is not None else -(2**62), r or "null", x or "") for c, t, r, x in rows if c == conv]
        escaped = lambda x: x.replace("\\", "\\\\").replace("<|", "<\\|")
        mine.sort(key=lambda m: (m[0], m[1], escaped(m[2])))
        assert [(t.role, t.content) for t in got[conv].turns] == [(r, x) for _, r, x in mine]
        assert got[conv].loss == "".join(x for _, r, x in mine if r == "assistant")
        assert got[conv].n_turns == len(mine)


def plain_tokens(kind, n, width, height, seconds, pages):
    if n is not None:
        return max(0, n)
    if kind == "image":
        tiles = -(-max(0, width or 0) // 512) * -(-max(0, height or 0) // 512)
        return 85 + 170 * tiles if tiles else 0
    if kind == "audio":
        return math.ceil(max(0, seconds or 0) * 25)
    return max(0, pages or 0) * 600 if kind == "document" else 0


def test_parts_become_placeholders_in_order(spark):
    none = (None,) * 4
    parts = [
        ("text", "see <|end|> <|attach:image#1|>", None, None, *none),
        ("image", None, "s3://i/1.png", 256, 9000, 9000, None, None),
        ("audio", "ignored", "a.wav", -3, *none),
        ("text", None, None, None, *none),
        (None, None, "r", None, 5, 5, 1.5, 5),
        ("document", None, "d.pdf", None, None, None, None, 3),
        ("image", None, "i", None, 513, 512, None, None), ("image", None, "i", None, 0, 512, None, None),
        ("audio", None, "i", None, None, None, 0.05, None), ("odd|>#7", None, None, None, *none),
    ]
    rows = [(1, 0, "user", parts), (1, 1, "assistant", None), (1, 2, "assistant", []), (1, 3, "assistant", parts[:2])]
    turns = spark.createDataFrame(rows, f"conv_id long, turn long, role string, parts array<{chat.PART}>")
    made = chat.format_conversations(turns)
    (row,) = made.withColumn("read", chat.read_turns(F.col("formatted"))).withColumn(
        "loss", chat.masked_text(F.col("formatted"), F.col("loss_spans"))
    ).collect()
    text = "see <\\|end|> <\\|attach:image#1|>"
    marks = ["image#1", "audio#2", "null#3", "document#4", "image#5", "image#6", "audio#7", "odd|\\>#7#8"]
    body = text + "".join(f"<|attach:{m}|>" for m in marks)
    last = f"<|assistant|>\n{text}<|attach:image#1|><|end|>"
    assert row.formatted == f"<|user|>\n{body}<|end|>" + "<|assistant|>\n<|end|>" * 2 + last
    wanted = [(p[0], p[2], plain_tokens(p[0], *p[3:]), k) for k, p in enumerate((p for p in parts if p[0] != "text"), 1)]
    assert [tuple(a) for a in row.attachments] == [*wanted, ("image", "s3://i/1.png", 256, 1)]
    assert [a.n_tokens for a in row.attachments] == [256, 0, 0, 1800, 425, 0, 2, 0, 256]
    assert row.read[0].placeholders == [*marks[:-1], "odd|>#7#8"] and row.read[0].content == parts[0][1]
    assert row.loss == parts[0][1] and len(row.loss_spans) == 3
    assert chat.format_conversations(turns.limit(0)).collect() == []


def test_query_has_every_kind_of_part(spark):
    from ladderweek.llm.queries import op8_chat_parts

    sf = "/root/testdata/sf0.01"
    turns = {}
    for r in spark.read.parquet(f"{sf}/conversations.parquet").collect():
        turns.setdefault(r.conv_id, []).append((r.turn, r.role, r.text or ""))
    got = {r.conv_id: r for r in op8_chat_parts(spark, sf).collect()}
    assert set(got) == {*turns, -7}
    kinds = Counter()
    for conv, rows in turns.items():
        r, rows = got[conv], sorted(rows)
        told = "".join(f"{role}\n{text}\n" for _, role, text in rows)
        loss = "".join(text for _, role, text in rows if role == "assistant")
        assert (r.n_turns, r.turns_sha256) == (len(rows), hashlib.sha256(told.encode()).hexdigest())
        assert (r.loss_chars, r.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
        assert r.placeholders == r.attached and len(r.refs) == len(r.expanded_tokens) == len(r.attached)
        kinds.update(a.split("#")[0] for a in r.attached)
        for name, ref in zip(r.attached, r.refs, strict=True):
            kind, at, turn = ref.split("/")
            assert name.startswith(kind) and int(at) == conv and (int(turn), "user") in {(t, role) for t, role, _ in rows}
    assert min(kinds[k] for k in ("image", "audio", "document")) > 10


RECORD = "record_id long, url string, ts long, status int, headers map<string,string>, body string, part int"


def test_revisits_equal_brute_force(spark):
    rng, rows = random.Random(9), []
    for i in range(400):
        url = rng.choice(["http://A.com", "https://a.com:443/", "http://a.com/#x", "http://b.com/p?b=1&a=2", "http://b.com/p?a=2&utm_x=1&b=1", "odd", None])
        ts = rng.choice([None, *range(0, 400_000, 20_000)])
        if rng.random() < 0.4:
            rows.append((i, url, ts, 200, {"ETag": f'"{ts}"', "Last-Modified": "d", "Vary": "x", "Content-Type": "t"}, f"body {i}", 0))
        else:
            etag = rng.choice([None, f'W/"{rng.choice(range(0, 400_000, 20_000))}"'])
            headers = {"etag": etag, "last-modified": rng.choice([None, "d", "e"]), "content-type": "no", "DATE": str(i), "Date": f"n{i}"}
            rows.append((i, url, ts, rng.choice([304, 304, 404]), rng.choice([headers, headers, headers, None]), None, 0))
    rows.append(rows[-1])
    canon = lambda u: {"odd": "odd", None: None}.get(u, None if u is None else ("a.com/" if "a.com" in u.lower() else "b.com/p?a=2&b=1"))
    want = Counter()
    for rid, url, ts, status, headers, _, _ in rows:
        if status != 304:
            continue
        before = [r for r in rows if r[3] == 200 and canon(r[1]) == canon(url) and url and None not in (ts, r[2]) and r[2] < ts]
        source = max(before, key=lambda r: (r[2], r[0])) if before else None
        own = {k.lower(): v for k, v in (headers or {}).items() if v is not None}
        if source is None:
            verdict = "no_earlier"
        elif not {"etag", "last-modified"} & set(own):
            verdict = "no_validator"
        elif "etag" in own:
            verdict = "resolved" if own["etag"][2:] == source[4]["ETag"] else "validator_mismatch"
        else:
            verdict = "resolved" if own["last-modified"] == "d" else "validator_mismatch"
        merged = body = None
        if verdict == "resolved":
            merged = {k.lower(): v for k, v in source[4].items()} | {k: v for k, v in own.items() if k != "content-type"}
            merged, body = tuple(sorted(merged.items())), source[5]
        want[rid, canon(url), source and source[0], verdict, merged, body] += 1
    for span in (86_400, 7, 10**9):
        got = revisits.resolve(spark.createDataFrame(rows, RECORD), span).collect()
        mine = Counter((*tuple(r)[:4], r.headers and tuple(sorted(r.headers.items())), r.body) for r in got)
        assert mine == want
    assert {"resolved", "no_validator", "no_earlier", "validator_mismatch"} == {k[3] for k in want}
    assert revisits.resolve(spark.createDataFrame([], RECORD)).collect() == []
