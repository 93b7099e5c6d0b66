"""Importance resampling, conversation repair, main text of pages."""
import hashlib
import math
import random
import re
import zlib
from functools import lru_cache

import pytest
from edge_cases import edge_rows
from pyspark.sql import functions as F

from recoengine.llm import conversations, html_layouts, html_text, resampling
from recoengine.session import scratch_path


def stored(spark, rows, ddl, name, files=2):
    path = scratch_path(spark, name)
    spark.createDataFrame(rows, ddl).repartition(files).write.parquet(path)
    return spark.read.parquet(path)


# --------------------------------------------------------------- resampling

def plain_features(text):
    low = bytes(c + 32 if 65 <= c <= 90 else c for c in (text or "").encode())
    words = re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    return len(words), [zlib.crc32(b" ".join(words[i:i + n])) % 10000 for n in (1, 2, 3) for i in range(len(words) - n + 1)]


def plain_resampling(rows, target, percent=5, min_words=20):
    found = [(i, *plain_features(t)) for i, t in rows]
    s, t = [0] * 10000, [0] * 10000
    for _, _, f in found:
        for b in f:
            s[b] += 1
    for text in target:
        for b in plain_features(text)[1]:
            t[b] += 1
    gain = [math.floor(1000 * math.log((t[b] + 1) * (sum(s) + 10000) / ((s[b] + 1) * (sum(t) + 10000)))) for b in range(10000)]
    out = []
    for i, n, f in found:
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        w = sum(gain[b] for b in f)
        out.append([i, n, len(f), w, w + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    enough = sorted((r for r in out if r[1] >= min_words), key=lambda r: (-r[4], r[0] is not None, r[0] or 0))
    for rank, r in enumerate(enough[:len(enough) * percent // 100], 1):
        r[5] = rank
    return sorted((tuple(r) for r in out), key=repr)


@pytest.mark.parametrize("percent,block", [(5, 1 << 16), (50, 7), (100, 1 << 16)])
def test_resampling_equals_the_plain_version(spark, edge, percent, block, monkeypatch):
    target = ["alpha beta w1 w2", None, "", edge_rows()[4][1]]
    goal = stored(spark, [(i, t) for i, t in enumerate(target)], "item_id long, text string", "target")
    got = resampling.resampled(edge, goal, percent=percent)
    want = plain_resampling([r[:2] for r in edge_rows()], target, percent)
    assert sorted((tuple(r[c] for c in ("doc_id", "n_words", "n_features", "weight", "score", "rank")) for r in got.collect()), key=repr) == want


def test_scan_equals_crc_of_each_run(monkeypatch):
    rng = random.Random(1)
    parts = ["a", "B9", "é漢", "--", "Zz-q", "don't", "\n", "\x00"]
    texts = [" ".join(rng.choice(parts + ["x" * rng.randrange(1, 150)]) for _ in range(rng.randrange(0, 40))).encode() for _ in range(200)]
    for block in (1, 7, 1 << 16):
        monkeypatch.setattr(resampling, "BLOCK", block)
        words, size, buckets = resampling.scan(texts)
        at = 0
        for t, n, m in zip(texts, words, size):
            want = plain_features(t.decode())
            assert n == want[0] and sorted(buckets[at:at + m].tolist()) == sorted(want[1])
            at += m
        assert at == len(buckets)


def test_drawn_documents_keep_columns_and_follow_the_target(spark):
    rng = random.Random(3)
    words = [f"common{i}" for i in range(200)]
    rows = [(i, " ".join(rng.choices([f"topic{j}" for j in range(50)] if i % 10 == 0 else words, k=60)), "r", i % 10) for i in range(300)]
    docs = stored(spark, rows, "doc_id long, text string, row string, score int", "docs")
    goal = stored(spark, [(0, " ".join(f"topic{j}" for j in range(50)) * 20)], "item_id long, text string", "goal")
    got = resampling.drawn_documents(docs, goal)
    assert got.columns == docs.columns
    assert len(got.collect()) == 15 and all(r.score == 0 for r in got.collect())


def test_resampling_of_nothing_and_equal_rows(spark, nothing):
    goal = stored(spark, [], "item_id long, text string", "empty-target")
    assert resampling.resampled(nothing, goal).count() == 0
    same = stored(spark, [(7, "w " * 30)] * 60, "doc_id long, text string", "same")
    got = resampling.resampled(same, goal).collect()
    assert sorted(r["rank"] for r in got if r["rank"]) == [1, 2, 3] and len({r.score for r in got}) == 1


def test_a_long_text_is_scanned_whole():
    text = (b"word%d " * 1) % 1
    text = b" ".join(b"w%d" % (i % 1000) for i in range(1_000_000))
    words, size, buckets = resampling.scan([text, b"x"])
    assert words.tolist() == [1_000_000, 1] and size.tolist() == [2_999_997, 1]
    assert buckets[-1] == zlib.crc32(b"x") % 10000


# ------------------------------------------------------------ conversations

SPACES = " \t\n\v\f\r"


def plain_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        role, text = role if role is not None else " ", text if text is not None else " "
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(conv, turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return out


def plain_repair(rows):
    """Recursion over (row, state) with whole edit strings, for short conversations."""
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode()))
    faults, seen = [], set()
    for _, _, role, text in rows:
        end = text.rstrip(SPACES)
        faults.append("blank" if not end else "duplicate" if (role, text) in seen else None if end[-1] in ".!?" else "truncated")
        seen.add((role, text))
    initials = [r[2][:1] for r in rows]
    step = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}
    made = {"": "user", "s": "user", "u": "assistant", "a": "user"}

    @lru_cache(None)
    def best(i, state, inserted):
        options = []
        if i == len(rows):
            if state in ("", "a"):
                options.append((0, "", ()))
        else:
            _, _, role, text = rows[i]
            late = 1 if faults[i] == "truncated" else 0
            c, e, o = best(i + 1, state, 0)
            options.append((3 + c, "D" + e, o))
            if faults[i] not in ("blank", "duplicate"):
                for letter, cost, new in (("K", 0, role), ("R", 2, made[state])):
                    if new[:1] in step[state] and (letter == "K" or new in ("user", "assistant")):
                        c, e, o = best(i + 1, step[state][new[:1]], 0)
                        options.append((cost + late + c, letter + e, (f"{new}:{text}", *o)))
        if inserted < 3:
            c, e, o = best(i, made[state][0], inserted + 1)
            options.append((2 + c, "I" + e, (f"{made[state]}:", *o)))
        return min(options, default=(10**9, "", ()))

    cost, audit, lines = best(0, "", 0)
    turns = {r[1] for r in rows if r[1] is not None}
    return (max(turns) - min(turns) + 1 - len(turns) if turns else 0, faults.count("blank"), faults.count("duplicate"), faults.count("truncated"),
            sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit,
            hashlib.sha256("\n".join(lines).encode()).hexdigest())


def conversation_rows():
    rng = random.Random(9)
    rows = [(None, None, None, None), (None, 1, "user", "a."), (-1, None, "user", None), (-2, 2, None, "x."), (-3, 5, "", "y."), (-4, 1, "assistant", "")]
    for conv in range(150):
        for turn in range(rng.randrange(0, 9)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", None, "usher"] if rng.random() < .3 else [("user", "assistant")[turn % 2]])
            text = rng.choice(["Yes.", "No!", "cut off", "  ", "", None, f"Text {turn}.", f"ünï {rng.random()}?", "tail. \n"])
            rows.append((conv, rng.choice([turn, turn + 3, None, turn - 1, 2**60 + turn]) if rng.random() < .3 else turn, role, text))
    return rows + rows[40:60]


def plain_all(rows):
    got = {}
    for r in plain_damage(rows):
        got.setdefault(r[0], []).append(r)
    return {conv: plain_repair(got.get(conv, [])) for conv in {r[0] for r in rows}}


@pytest.mark.parametrize("buffer_rows", [100_000, 2])
def test_repair_equals_the_plain_version(spark, buffer_rows):
    rows = conversation_rows()
    table = stored(spark, [(*r, "x", "x") for r in rows], "conv_id long, turn long, role string, text string, fault string, seq string", "conversations", 3)
    got = conversations.repaired(conversations.with_faults(conversations.damaged(table)), buffer_rows=buffer_rows).collect()
    want = plain_all(rows)
    assert len(got) == len(want)
    for r in got:
        assert tuple(r)[1:] == want[r.conv_id], r.conv_id
        out = "".join("I" if x == "I" else x for x in r.audit)
        assert set(out) <= set("DIKR")


def test_repair_of_the_given_table(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    want = plain_all(rows)
    got = conversations.op12_conversation_repair(spark, sf_dir).collect()
    assert {r.conv_id: tuple(r)[1:] for r in got} == want and len(got) == len(want)


def test_a_giant_conversation_is_streamed(spark):
    rows = [(1, t, ("user", "assistant")[t % 2], f"text {t}" + "." * (t % 3)) for t in range(3000)]
    table = stored(spark, rows, "conv_id long, turn long, role string, text string", "giant")
    faults = conversations.with_faults(conversations.damaged(table))
    whole = conversations.repaired(faults).collect()
    assert whole == conversations.repaired(faults, buffer_rows=100).collect() == conversations.repaired(faults, buffer_bytes=500).collect()


def test_no_conversations(spark):
    table = stored(spark, [], "conv_id long, turn long, role string, text string", "no-conversations")
    assert conversations.repaired(conversations.with_faults(conversations.damaged(table))).count() == 0


# --------------------------------------------------------------------- html

@pytest.fixture(scope="module")
def weights():
    return html_text.Weights(html_text.layout_counts())


def article(*blocks):
    return "<article>" + "".join(f"<p>{b}</p>" for b in blocks) + "</article>"


def test_given_pages_give_their_article(spark, sf_dir):
    import html
    source = {r.page_id: r.html for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    got = html_text.op13_html_extraction(spark, sf_dir).collect()
    assert len(got) == len(source)
    for r in got:
        inside = source[r.page_id].split("<article>", 1)[1].split("</article>")[0]
        plain = re.sub(r"</?b>", "", re.sub(r"</?(?:p|h1|br)>", " ", inside))
        assert r.text == " ".join(html.unescape(plain).split()) and r.n_chars == len(r.text)


LONG = " ".join(f"word{i}" for i in range(40))


@pytest.mark.parametrize("body,want", [
    (f"<header>Site</header>{article('One &amp; two.', LONG)}<footer>Foot</footer>", f"One & two. {LONG}"),
    (f"<div class='cookie-banner'>We use cookies</div><main><h1>Title</h1><p>a<b>b</b> c</p><p>{LONG}</p></main>", f"Title ab c {LONG}"),
    (f"<div id='nav-menu'><a href=x>Home</a></div><div id=content><p>{LONG}</p><p>End.</p></div><div class=comments><p>{LONG}</p></div>", f"{LONG} End."),
    (f"<article><p>{LONG}</p><div class='ad'>Buy</div><script>var a='</p><p>no';</script><p>More&nbsp;text</p><form>Name<input></form></article>", f"{LONG} More text"),
    (f"<form id=aspnet><nav>m</nav><main><p>{LONG}</p></main></form>", LONG),
    (f"<article class='with-sidebar'><p>{LONG}</p><!-- gone --><p hidden>no</p></article><article class='comment'><p>{LONG}</p></article>", LONG),
    (f"{article(LONG)}<div>Copyright us</div><p>after <a href=y>it</a></p>", LONG),
    (f"<ul><li><a href=1>a</a></li><li><a href=2>b</a></li></ul><div>{LONG}<br>x < y</div><div><a href=3>more</a></div>", f"{LONG} x < y"),
    ("", ""), (None, ""), ("<nav><a href=x>only menu</a></nav>", ""), ("<script>never closed", ""),
    (LONG, LONG), (f"{article(LONG)[:-10]}", LONG), (f"<article><p>{LONG}<p>cut &am", f"{LONG} cut &am"),
    (f"<article><p title='a > b'>{LONG}</p><img alt='x", LONG),
])
def test_main_text(weights, body, want):
    assert html_text.main_text(body, weights) == want


def test_learnt_from_pages_or_from_layouts_alone(spark):
    empty = stored(spark, [], "page_id long, url string, html string", "no-pages")
    assert html_text.extracted(empty, html_text.learnt(empty)).count() == 0
    rows = [(i, f"u{i}", f"<html><body><nav><a href=x>m</a></nav>{article(LONG, f'page {i}')}</body></html>", "x") for i in range(50)] + [(None, None, None, "x")]
    pages = stored(spark, rows, "page_id long, url string, html string, text string", "some-pages")
    got = {r.page_id: r.text for r in html_text.extracted(pages, html_text.learnt(pages, sample=10)).collect()}
    assert got == {i: f"{LONG} page {i}" for i in range(50)} | {None: ""}


def test_best_run_is_the_best_of_all_runs():
    rng = random.Random(4)
    for _ in range(300):
        s = [rng.choice([-3, -1, 0, 2, 1]) for _ in range(rng.randrange(0, 12))]
        a, b = html_text.best_run(s)
        assert sum(s[a:b]) == max([sum(s[i:j]) for i in range(len(s)) for j in range(i, len(s) + 1)], default=0)


def test_hand_marked_layouts_are_found_when_left_out():
    """Each layout by weights learnt from the others."""
    for i, page in enumerate(html_layouts.LAYOUTS):
        rest = sum((html_text.Page(p, html_layouts.MARK).counts(False) for j, p in enumerate(html_layouts.LAYOUTS) if j != i), type(html_text.layout_counts())())
        marked = html_text.Page(page, html_layouts.MARK)
        want = sum(n for n, m, f in zip(marked.words, marked.labels, marked.features) if m and f[0] in html_text.OPEN_ZONES)
        got = len(html_text.main_text(page, html_text.Weights(rest)).split())
        assert abs(got - want) <= 0.1 * want, (i, got, want)


def test_a_long_page(weights):
    blocks = [f"{LONG} {i}" for i in range(20_000)]
    assert html_text.main_text(f"<nav>x</nav>{article(*blocks)}", weights) == " ".join(blocks)
