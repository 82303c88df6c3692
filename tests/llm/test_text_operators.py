"""Matroska, decontamination, BPE, chat and HTML against brute force, round trips and odd rows."""

import hashlib
import itertools
import random
import re
import zlib

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from corpusloom.llm import bpe, chat, decontamination, media, mincut
from corpusloom.llm.bytewords import NON_ALNUM, SPACES, split

from .odd import documents

AZ = str.maketrans({c: c + 32 for c in range(65, 91)})


# -- words ---------------------------------------------------------------------------------------------------------------


@given(st.lists(st.text(max_size=40), max_size=6))
@settings(max_examples=150, deadline=None)
def test_split_agrees_with_regular_expressions(texts):
    for table, pattern in ((SPACES, r"[^\x20\x09-\x0D]+"), (NON_ALNUM, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")):
        texts = [t.encode("utf-8", "ignore").decode() for t in texts]
        w = split(pa.array(texts, pa.string()), table)
        found = [w.data[a:b].tobytes().decode() for a, b in zip(w.starts, w.ends)]
        want = [re.findall(pattern, t.translate(AZ)) for t in texts]
        assert found == [x for ws in want for x in ws]
        assert w.counts.tolist() == [len(ws) for ws in want]
        assert len(set(w.hashes().tolist())) == len(set(found))


# -- Matroska --------------------------------------------------------------------------------------------------------------


@given(st.binary(max_size=3000))
@settings(max_examples=60, deadline=None)
def test_mux_round_trip(data):
    payload = media.padded(data)
    assert len(payload) % 64 == 0 and len(payload) >= 64 and payload.startswith(data)
    assert media.samples(media.mux(payload)) == payload


def test_long_media_has_clusters_cues_and_laces():
    payload = bytes(i * 7 % 251 for i in range(200_000 // 64 * 64))
    m = media.demux(media.mux(payload))
    assert len(m.clusters) == len(m.cues) > 2 and {p.lacing for p in m.packets} >= {"fixed"}
    assert [p.timestamp_ns for p in m.packets] == [i * 64_000_000 for i in range(len(m.packets))]
    assert m.tracks[1]["codec"] == "A_PCM/INT/LIT"


def _el(ident, *parts):
    return media._element(ident, b"".join(parts))


def _num(ident, n):
    return _el(ident, n.to_bytes(2, "big"))


def _segment(frames, cues):
    """A segment of one cluster with a block for each (track, frame), then cues: lists of (track, block number) for each point."""
    blocks = [_el(media.SIMPLE_BLOCK, bytes([0x80 | t]) + b"\x00\x00\x80" + f) for t, f in frames]
    head = _num(media.TIMESTAMP, 7)
    places = [len(head) + sum(map(len, blocks[:i])) for i in range(len(blocks))]
    points = [_el(media.CUE_POINT, _num(media.CUE_TIME, 7), *[_el(media.CUE_TRACK_POSITIONS, _num(media.CUE_TRACK, t), _num(media.CUE_CLUSTER_POSITION, 0), _num(media.CUE_RELATIVE_POSITION, places[k])) for t, k in point]) for point in cues]
    return _el(media.SEGMENT, _el(media.CLUSTER, head, *blocks), _el(media.CUES, *points))


def test_a_cue_point_of_several_tracks_and_segments():
    header = _el(media.EBML, _el(media.DOC_TYPE, b"matroska"))
    m = media.demux(header + _segment([(1, b"a"), (2, b"bb")], [[(1, 0), (2, 1)]]))
    assert [p.cued for p in m.packets] == [True, True] and len(m.cues) == 2 and m.lost_cues == 0
    # clusters at equal positions of two segments are not taken for each other
    m = media.demux(header + _segment([(1, b"a"), (1, b"b")], []) + _segment([(1, b"c"), (1, b"d")], [[(1, 1)]]))
    assert [p.cued for p in m.packets] == [False, False, False, True]


def _block(kind, frames):
    sizes, body = [len(f) for f in frames], b"".join(frames)
    if kind == 1:
        lace = b"".join(b"\xff" * (s // 255) + bytes([s % 255]) for s in sizes[:-1])
    elif kind == 3:
        return media._block(frames, 5)
    else:
        lace = b""
    return b"\x81" + (5).to_bytes(2, "big") + bytes([0x80 | kind << 1]) + bytes([len(frames) - 1]) + lace + body


@pytest.mark.parametrize("kind,frames", [(1, [b"a" * 600, b"b" * 255, b"c"]), (2, [b"aa", b"bb"]), (3, [b"a" * 500, b"b" * 10, b"c" * 700, b"d"])])
def test_lacing(kind, frames):
    m = media.Media()
    d = _block(kind, frames)
    media._packets(d, 0, len(d), 100, 1_000_000, m, None)
    assert [d[p.start : p.start + p.size] for p in m.packets] == frames and m.packets[0].timestamp_ns == 105_000_000


def test_unknown_sizes_and_broken_files():
    whole = media.mux(media.padded(b"hello" * 100))
    at = whole.index((media.SEGMENT).to_bytes(4, "big")) + 4
    width = 9 - whole[at].bit_length()
    unknown = whole[:at] + b"\x01" + b"\xff" * 7 + whole[at + width :]
    assert media.samples(unknown) == media.padded(b"hello" * 100)
    for broken in (b"", b"\x00", whole[: len(whole) // 2], b"\x1a\x45\xdf\xa3\xff"):
        with pytest.raises((ValueError, IndexError)):
            media.demux(broken)


def test_media_columns_and_packet_table(spark):
    docs = documents(spark)
    out = media.stored(docs, "text", {"doc_id": F.col("doc_id")}).select("row.doc_id", "res.*")
    rows = out.collect()
    texts = [r.text or "" for r in docs.collect()]
    assert len(rows) == len(texts)
    for r, t in zip(rows, texts):
        payload = media.padded(t.encode())
        assert (r.n_bytes, r.payload_bytes, r.tail_crc32) == (len(t.encode()), len(payload), zlib.crc32(payload[-64:]))
        assert r.payload_sha256 == hashlib.sha256(payload).hexdigest() and r.media_sha256 == hashlib.sha256(r.media).hexdigest()
    packets = media.packet_table(out.union(out.limit(1).withColumn("media", F.lit(b"junk")).withColumn("doc_id", F.lit(99).cast("long"))))
    assert packets.where("error is null").groupBy().sum("size").first()[0] == sum(r.payload_bytes for r in rows)
    assert packets.where("doc_id = 99").first().error


# -- decontamination ------------------------------------------------------------------------------------------------------------


def brute_hits(text, items, size=10):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(AZ))
    hit, found = set(), set()
    for ident, item in items:
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (item or "").translate(AZ))
        n = min(size, len(w))
        grams = {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if w else set()
        for i in range(len(words) - n + 1) if n else ():
            if tuple(words[i : i + n]) in grams:
                hit |= set(range(i, i + n))
                found.add(str(ident))
    return len(words), len(hit), sorted(found)


@pytest.mark.parametrize("block", [40_000, 3])
def test_decontamination_against_brute_force(spark, block):
    rng = random.Random(4)
    words = [f"w{i}" for i in range(12)]
    items = [(i, " ".join(rng.choice(words) for _ in range(rng.choice([3, 9, 10, 14])))) for i in range(6)] + [(7, ""), (8, None), (9, "The Cat, sat on a mat and saw ten big DOGS run")]
    texts = [" ".join(rng.choice(words) for _ in range(200)) + " " + items[i % 6][1].upper() + ", tail" for i in range(8)]
    docs = documents(spark).select("doc_id", "text").union(spark.createDataFrame(enumerate(texts, 100), "doc_id long, text string"))
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontamination.scan(docs, bench, {"doc_id": F.col("doc_id"), "text": F.col("text")}, block=block).collect()
    assert len(got) == docs.count()
    for r in got:
        assert (r.res.n_words, r.res.n_hit, list(r.res["items"])) == brute_hits(r.row.text, items)
        for s in r.res.spans:
            assert brute_hits(r.row.text[s.start : s.end], items)[1] > 0


def test_no_items_and_no_documents(spark):
    bench = spark.createDataFrame([], "item_id long, text string")
    assert decontamination.scan(documents(spark), bench, {"doc_id": F.col("doc_id")}).where("res.n_hit > 0").count() == 0
    assert decontamination.scan(documents(spark, []), bench, {"doc_id": F.col("doc_id")}).count() == 0


# -- BPE ------------------------------------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def word_bpe():
    P = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    path = P.path("word_bpe_49k.json")
    return path, Tokenizer.from_file(path), bpe.Vocabulary(open(path, encoding="utf-8").read())


def test_bpe_agrees_with_the_library(word_bpe):
    _, theirs, mine = word_bpe
    rng = random.Random(1)
    alphabet = "abcXYZ 'Σİéé 1234٣ !?.,<|endoftext|>中文 \x1c\x85\U0001f600'sREll\t\n"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 80))) for _ in range(1500)]
    texts += ["it's <|endoftext|> we'LL<|startoftext|>x", "a" * 500 + "ab" * 300, "", "x" * 97, "hello" * 40, "<|endoftext|"]
    for t, ids in zip(texts, mine.encode_batch(texts)):
        want = theirs.encode(t, add_special_tokens=False).ids
        assert [int.from_bytes(ids[i : i + 4], "little") for i in range(0, len(ids), 4)] == want, t
        assert mine.decode(ids) == theirs.decode(want, skip_special_tokens=False)


def test_bpe_columns(spark, word_bpe):
    path, theirs, _ = word_bpe
    got = bpe.encoded(documents(spark), path, {"doc_id": F.col("doc_id"), "text": F.col("text")}).collect()
    for r in got:
        ids = theirs.encode(r.row.text or "", add_special_tokens=False).ids
        assert r.res.n_tokens == len(ids) and r.res.ids == b"".join(i.to_bytes(4, "little") for i in ids)
        assert r.res.decoded == theirs.decode(ids, skip_special_tokens=False)
    assert bpe.encoded(documents(spark, []), path, {"doc_id": F.col("doc_id")}).count() == 0


def test_cache_stays_bounded(word_bpe, monkeypatch):
    _, theirs, mine = word_bpe
    monkeypatch.setattr(bpe, "CACHE", 20)
    for k in range(5):
        texts = [f"word{k} number{i}" for i in range(30)]
        assert mine.encode_batch(texts) == [b"".join(i.to_bytes(4, "little") for i in theirs.encode(t, add_special_tokens=False).ids) for t in texts]
        assert len(mine.cache) <= 20


# -- chat -----------------------------------------------------------------------------------------------------------------------


CONVERSATIONS = [
    (1, 0, "system", "be kind"), (1, 1, "user", "hi </turn>\n### Assistant: x"), (1, 2, "assistant", "\\</turn>\\\\ ### User: \\"), (2, 0, "assistant", "early"), (2, 1, "user", None), (3, 0, None, None),
    (4, 5, "user", "tie b"), (4, 5, "user", "tie a"), (4, 6, "assistant", ""), (5, 0, "to:ol %x", "odd role"), (None, 0, "user", "no id"), (None, 1, "assistant", "é\U0001f600"), (6, 0, "user", "q"), (6, 0, "user", "q"),
]


def test_chat_round_trip(spark):
    rows = spark.createDataFrame(CONVERSATIONS, "conv_id long, turn long, role string, text string").withColumn("segments", F.lit(1))
    got = {r.conv_id: r for r in chat.read_back(chat.segments(rows)).collect()}
    order = lambda r: (r[1], r[2] or "", r[3] or "")
    for ident, group in itertools.groupby(sorted(CONVERSATIONS, key=lambda r: (str(r[0]), order(r))), key=lambda r: r[0]):
        turns = sorted(group, key=order)
        r = got[ident]
        assert r.n_turns == len(turns)
        assert r.turns_sha256 == hashlib.sha256("".join(f"{x[2] or ''}\n{x[3] or ''}\n" for x in turns).encode()).hexdigest()
        loss = "".join(x[3] or "" for x in turns if x[2] == "assistant")
        assert (r.loss_chars, r.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert {k for k, r in got.items() if r.valid} == {1, None}
    assert chat.read_back(chat.segments(rows.limit(0))).count() == 0


@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system"]), st.text(alphabet="\\#</turn>: UserAssistant\n", max_size=30)), max_size=6))
@settings(max_examples=200, deadline=None)
def test_escaping_is_reversible(turns):
    pattern = re.compile("(" + "|".join([r"\\", *(re.escape(c) for c in sorted(chat.CHAT.controls, key=len, reverse=True))]) + ")")
    text = "".join(chat.CHAT.headers[r] + pattern.sub(r"\\\1", t) + chat.CHAT.end for r, t in turns)
    assert [(r, t) for r, t, _ in chat.parsed(text)] == turns


def test_machine():
    def verdict(*roles):
        m = chat.Machine(chat.CHAT)
        for r in roles:
            m.step(r)
        return m.verdict()

    assert verdict("user", "assistant", "user", "assistant") == "" and verdict("system", "user", "assistant") == ""
    assert "ends in" in verdict("user") and "turn 2" in verdict("user", "user") and "ends in start" in verdict()


# -- HTML -----------------------------------------------------------------------------------------------------------------------

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>
<header class="site-header"><a href="/">Home</a></header><nav><ul><li><a href="/a">A</a><li><a href="/b">B</a></ul></nav><div class="ad">Buy this now, it is great.</div>
<article><h1>A   title &amp; more</h1><p><b>First &lt;para&gt;<br>line.<p>Second&nbsp;para
with break.</p><ul><li>one thing to say here<li>another thing</ul><p>Ok.</p></article>
<div id="comments"><p>A reader comment that is long enough to look like a real paragraph of the page itself.</p></div>
<aside>Related stories for you</aside><div class="cookie-notice">We use cookies.</div><form><p>Sign up to our newsletter today.</p></form><footer>&copy; 2024 All rights.</footer></body></html>"""


def test_main_text():
    assert mincut.main_text(PAGE) == "A title & more\nFirst <para> line.\nSecond para with break.\none thing to say here\nanother thing\nOk."
    assert mincut.main_text("") == "" and mincut.main_text("<nav><a href='/'>x</a></nav>") == ""
    assert mincut.main_text("<p>Plain paragraph without any article element, but with enough words to be read.") != ""
    assert mincut.main_text("<article>" + "<div>" * 3000 + "<p>Deep text that goes on for a while, to be content." + "</div>" * 10) != ""


PARAGRAPH = "This is one full paragraph of the article, and it says something that a reader wants to know. It goes on."
ARTICLE = "".join(f"<p>{PARAGRAPH} {i}</p>" for i in range(8))
WHOLE = "\n".join(f"{PARAGRAPH} {i}" for i in range(8))
LONE = [f"One sentence number {i} stands here alone." for i in range(24)]


@pytest.mark.parametrize("html", [
    f"<html><head><title>t</title></head><body><nav><a href=x>Home</a></nav><article>{ARTICLE}</article><footer>&copy; x</footer></body></html>",
    f'<body class="post-template single with-sidebar"><article>{ARTICLE}</article></body>', f'<body class="has-sidebar cookie-ok"><nav><a href=x>Home</a></nav><article>{ARTICLE}</article></body>',
    f"<html><head><title>t</title><meta charset=utf-8><body><article>{ARTICLE}</article>", f"<html><head><title>t</title><article>{ARTICLE}</article>",
    f'<div class="page-with-sidebar"><div class="sidebar"><p>Some words here.</p></div>{ARTICLE}</div>', f'<div class="layout sidebar">{ARTICLE}</div>',
    f'<article class="post-12 type-post tag-sponsor comments-open category-news">{ARTICLE}</article><div id="comments"><ol class="comment-list"><li><article class="comment-body"><p>{PARAGRAPH}</p></article></li></ol></div>',
    f'<main>{ARTICLE}<form><label>Your mail</label><p>Sign up for the letter, it is free.</p></form></main><div class="comments"><p>{PARAGRAPH}</p><p>{PARAGRAPH}</p></div>',
    f'<article>{ARTICLE}</article><section id="reader-comments">' + f"<p>{PARAGRAPH}</p>" * 90 + "</section>",
    f'<div role="alertdialog">We use cookies, please agree.</div><div class="content">{ARTICLE}</div><div class="footer-links"><a href=1>a</a> <a href=2>b</a></div>',
    f"<div><a href=1>Home</a> <a href=2>News</a></div><div>{ARTICLE}</div><div><a href=1>Imprint</a></div><div>© 2020 Someone</div>",
    f'<article>{ARTICLE}<div class="ad">Buy this thing now, it is good.</div><aside>Read this, too.</aside></article>',
])
def test_pages_of_other_layouts(html):
    assert mincut.main_text(html) == WHOLE


@pytest.mark.parametrize("n", [1, 8, 24])
def test_pages_of_lone_sentences(n):
    assert mincut.main_text("<body>" + "".join(f"<div>{x}</div>" for x in LONE[:n])) == "\n".join(LONE[:n])


def test_classifier_on_pages_it_did_not_learn_from():
    from corpusloom.llm import mincut_training

    wrong = total = 0
    for html in mincut_training.pages(150, seed=99):
        blocks = mincut.blocks_of(html)
        want = [b.text.startswith(mincut_training.MARK) for b in blocks]
        for b in blocks:
            b.text = b.text.replace(mincut_training.MARK, "").strip()
        got = mincut.minimum_cut(mincut.evidence(mincut.Page(blocks), mincut.weights()), mincut.smoothness(blocks))
        wrong, total = wrong + sum(a != b for a, b in zip(got, want)), total + len(want)
    assert total > 2000 and wrong < total / 100


def test_parsing_takes_linear_time():
    import time

    def seconds(n):
        begun = time.process_time()
        for html in ("<b>" * n + "x</p>" * n, "<i><div>" + "<b>" * n + "</i>" * n, "<p><body>" + "<b>" * n + "<hr>" * n, "<li>" + "<div>" * n + "<dt>x" * n):
            mincut.blocks_of(html)
        return time.process_time() - begun

    seconds(500)
    assert seconds(16_000) < 40 * max(seconds(1000), 0.005)


def test_inline_ends_stay_in_their_block():
    html = "<b><div>one<p>two</b> three</p></div><a href=x>li<div>nk</a> on</div>"
    assert [(b.text, b.owner.tag) for b in mincut.blocks_of(html)][:3] == [("one", "div"), ("two three", "p"), ("li", "")]


def test_minimum_cut_is_minimal():
    rng = random.Random(2)
    for _ in range(300):
        n = rng.randint(1, 8)
        score = [rng.randint(-9, 9) for _ in range(n)]
        edges = [(a, b, rng.randint(1, 6)) for a in range(n) for b in range(a + 1, n) if rng.random() < 0.5]

        def cost(label):
            return sum(max(-s, 0) if k else max(s, 0) for s, k in zip(score, label)) + sum(c for a, b, c in edges if label[a] != label[b])

        assert cost(mincut.minimum_cut(score, edges)) == min(cost(x) for x in itertools.product((False, True), repeat=n))


def test_long_chain_of_even_blocks():
    n = 3000
    assert len(mincut.minimum_cut([1 if i % 2 else -1 for i in range(n)], [(i, i + 1, 3) for i in range(n - 1)])) == n


def test_page_columns(spark):
    pages = spark.createDataFrame([(1, "u", PAGE), (2, None, None), (3, "u", ""), (3, "u", "")], "page_id long, url string, html string").withColumn("text", F.lit("clash"))
    got = mincut.extracted(pages, {"page_id": F.col("page_id")}).select("row.page_id", "res.*").collect()
    assert [r.n_chars for r in got] == [len(mincut.main_text(PAGE)), 0, 0, 0]
    assert mincut.extracted(pages.limit(0), {"page_id": F.col("page_id")}).count() == 0


@pytest.mark.parametrize("tag", ["form", "header", "section role='dialog'", "aside class='sidebar'"])
@pytest.mark.parametrize("inner", ["<article>%s</article>", "<div class='content'>%s</div>", "%s", "<main><h1>T</h1>%s</main>"])
def test_a_container_round_the_whole_page_says_nothing(tag, inner):
    said = [f"This is the sentence number {i} of a proper article, with commas, and it ends here. It says more." for i in range(8)]
    nav = "<nav><ul><li><a href='/a'>Home</a></li><li><a href='/b'>News</a></li></ul></nav>"
    body = inner % "".join(f"<p>{p}</p>" for p in said)
    page = f"<html><head><title>x</title></head><body><{tag}>{nav}{body}<footer>© 2024 Corp | <a href='/t'>Terms</a></footer></{tag.split()[0]}></body></html>"
    assert mincut.main_text(page) == "\n".join((["T"] if "<h1>" in inner else []) + said)
