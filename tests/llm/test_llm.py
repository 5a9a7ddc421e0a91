import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from loomwell.llm import html_extract, quality, secrets, spm_fst, toxicity, warc
from loomwell.llm.components import components
from loomwell.llm.decontam import decontaminate
from loomwell.llm.line_dedup import line_dedup
from loomwell.llm.ngram_join import ngram_join
from loomwell.llm.pieces import Pieces
from loomwell.llm.queries import model_path
from loomwell.llm.spm_fst import Transducer, decode, encode
from loomwell.llm.token_counts import longest_within, prefix_counts, token_counts

random.seed(5)
WORDS = [f"w{i}" for i in range(400)]
WS = " \t\n\x0b\f\r"


def frame(spark, rows, schema="doc_id long, text string, lang string, source string"):
    rows = [tuple(r) + ("en", "s")[: len(schema.split(",")) - len(r)] for r in rows]
    return spark.createDataFrame(rows, schema)


def near_copies():
    base = [random.choice(WORDS) for _ in range(60)]
    rows = [(1, " ".join(base)), (2, " ".join(base)), (3, None), (4, ""), (5, "one two"), (6, "ONE  two"), (7, " \t ")]
    for i in range(8, 40):
        own = list(base)
        for _ in range(random.randint(0, 4)):
            own[random.randrange(60)] = random.choice(WORDS)
        rows.append((i, " ".join(own)))
    rows += [(i, " ".join(random.choice(WORDS) for _ in range(30))) for i in range(40, 60)]
    return rows


def brute_components(rows, k=5):
    sets = {}
    for i, t in rows:
        w = [x for x in re.split("[ \t-\r]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) if x]
        sets[i] = {tuple(w[j : j + k]) for j in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())
    label = {i: i for i in sets}
    changed = True
    while changed:
        changed = False
        for a in sets:
            for b in sets:
                if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]) and label[a] != label[b]:
                    low, high = sorted((label[a], label[b]))
                    label = {i: low if x == high else x for i, x in label.items()}
                    changed = True
    return {i: (len(sets[i]), label[i]) for i in sets}


@pytest.mark.parametrize("frequent", [512, 1])
def test_ngram_join(spark, frequent):
    import loomwell.llm.ngram_join as nj

    rows = near_copies()
    got = {r.id: (r.n_shingles, r.component_id) for r in ngram_join(frame(spark, rows), sketch_bits=16, frequent=frequent).collect()}
    assert got == brute_components(rows)
    assert nj.prefix_units(np.arange(10, dtype=np.uint64), np.ones(10), 1, 4, 2, 0)[1]


@pytest.mark.parametrize("part", [2048, 4])
def test_ngram_join_counts_links(spark, monkeypatch, part):
    import loomwell.llm.ngram_join as nj

    monkeypatch.setattr(nj, "PART_SETS", part)
    rows = near_copies() + [(70, "p q r s t u v w x y z a b c d e f g h i j k l m n")]
    rows += [(i, rows[-1][1] + f" end{i}") for i in (71, 72)]
    sets = {}
    for i, t in rows:
        w = (t or "").lower().split()
        sets[i] = {tuple(w[j : j + 5]) for j in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    links = {a: sum(a != b and bool(sets[a]) and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]) for b in sets) for a in sets}
    got = {r.id: r.n_links for r in ngram_join(frame(spark, rows), sketch_bits=16).collect()}
    assert got == links and [got[i] for i in (70, 71, 72)] == [2, 2, 2]


def test_ngram_join_edges(spark):
    assert ngram_join(frame(spark, [(1, "a")]).limit(0), sketch_bits=16).count() == 0
    got = ngram_join(frame(spark, [(None, "a b c d e f"), (2, "a b c d e f"), (2, "a b c d e f")]), sketch_bits=16).collect()
    assert sorted((r.id is None, r.component_id) for r in got if r.id is not None) == [(False, 2), (False, 2)] and len(got) == 3


def test_components(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(20)] + [(50, 40)], "a long, b long")
    assert {(r.node, r.label) for r in components(links).collect()} == {(i, 0) for i in range(21)} | {(40, 40), (50, 40)}


def test_line_dedup(spark):
    rows = [(2, "A shared line here\nown"), (1, " a SHARED line here \nshort\na shared line here"), (3, "short\na shared line here"), (4, None), (5, ""), (None, "a shared line here")]
    got = {r.doc_id: (r.ld_n_lines, r.ld_n_dropped, r.ld_text) for r in line_dedup(frame(spark, rows)).collect()}
    assert got == {2: (2, 1, "own"), 1: (3, 0, rows[1][1]), 3: (2, 1, "short"), 4: (1, 0, ""), 5: (1, 0, ""), None: (1, 0, "a shared line here")}
    three = {r.doc_id: r.ld_n_dropped for r in line_dedup(frame(spark, rows), min_docs=4).collect()}
    assert not any(three.values())


BENCH = [(1, "The quick brown fox jumps over the lazy dog and then sleeps"), (2, "tiny item"), (3, None), (4, "...")]
DIRTY = "So: the QUICK brown, fox jumps over the lazy dog and then ran. A tiny item é!"


@pytest.mark.parametrize("limit", [1 << 20, -1])
def test_decontaminate(spark, limit):
    docs = frame(spark, [(1, DIRTY), (2, None), (3, "clean words"), (4, DIRTY), (5, "")])
    bench = spark.createDataFrame(BENCH, "item_id long, text string")
    got = {r.doc_id: r for r in decontaminate(docs, bench, broadcast_windows=limit, clean=True).collect()}
    assert (got[1].dc_n_words, got[1].dc_n_hit, got[1].dc_items) == (17, 13, ["1", "2"])
    assert got[1].dc_text == "So:  ran. A  é!" and got[1].dc_text == got[4].dc_text
    assert got[2].dc_n_hit == got[3].dc_n_hit == got[5].dc_n_hit == 0 and got[3].dc_text == "clean words"
    assert decontaminate(docs, bench.limit(0)).where("dc_n_hit > 0").count() == 0


@pytest.mark.parametrize("limit", [1 << 20, -1])
def test_decontaminate_names_item_zero(spark, limit):
    docs = frame(spark, [(1, DIRTY), (2, "tiny item"), (3, "odd one")])
    bench = spark.createDataFrame([(0, BENCH[0][1]), (2, "tiny item"), (0, "odd one"), (None, "odd one")], "item_id long, text string")
    got = {r.doc_id: r.dc_items for r in decontaminate(docs, bench, broadcast_windows=limit).collect()}
    assert got == {1: ["0", "2"], 2: ["2"], 3: ["", "0"]}


TEXTS = ["", " ", "Hello  world", "日本語 テスト", "😀😀 b\n\t", "aaaaaaaaaaaaaa", "<s> <0x0A> ▁x", "0123456789" * 5, "e" * 300]


def test_tokenizer_against_library(spark):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=model_path())
    model = Pieces.load(model_path())
    machine = Transducer(model)
    texts = TEXTS + ["".join(random.choice("abcdehit  \n.,=$(é²²日😀AB▁1") for _ in range(random.randint(1, 50))) for _ in range(300)]
    for t in texts:
        assert machine.encode(t) == sp.encode(t), t
        assert machine.decode(sp.encode(t)) == t.replace("▁", " ")
    assert model.chunks("▁ab,▁(c)▁1²$") == ["▁ab", ",", "▁(c", ")", "▁", "1", "²$"]
    for t in texts[:60]:
        counts = prefix_counts(model, t)
        assert counts == [len(sp.encode(t[:i])) for i in range(len(t) + 1)]
        assert counts[longest_within(counts, 3)] <= 3
    docs = frame(spark, [(i, t) for i, t in enumerate(TEXTS)] + [(99, None)])
    n = {r.doc_id: r for r in token_counts(docs, model_path(), limit=5, prefixes=True).collect()}
    for r in encode(docs, model_path()).collect():
        assert r.sp_round_trip and r.sp_n_tokens == n[r.doc_id].tc_n_tokens == len(r.sp_ids) == n[r.doc_id].tc_prefix[-1]
    back = {r.doc_id: r.sp_text for r in decode(encode(docs, model_path()), model_path()).collect()}
    assert back[2] == "Hello  world" and back[99] == ""


def test_character_map_against_library():
    import sentencepiece

    from loomwell.llm.pieces import CharMap, _fields

    texts = [*TEXTS, "\ufb01ne \u2460\u2461 \uff76\uff9e \xc0\xc9 \u2167 \xa0x\u3000y", "\uff21\uff22\uff23\uff11", "\u337f", "a\tb\r\nc", "e\u0301 \u1100\u1161"]
    for rule in ("nmt_nfkc", "nfkc", "nmt_nfkc_cf"):
        own = sentencepiece.SentencePieceNormalizer(rule_name=rule, add_dummy_prefix=False, escape_whitespaces=False, remove_extra_whitespaces=False)
        spec = next(dict(_fields(v)) for k, v in _fields(own.serialized_model_proto()) if k == 3)
        chars = CharMap(spec[2])
        for t in texts:
            assert chars.apply(t) == own.normalize(t)
    model = Pieces(["<unk>", "\u2581", "f", "i"], [0, -1.0, -1.0, -1.0], [2, 1, 1, 1], False, False, True, True, chars)
    assert Transducer(model).encode("\ufb01") == [1, 2, 3]


def test_caches_are_of_one_model():
    from loomwell.llm.pieces import in_process

    texts, kinds = ["<unk>", "<s>", "</s>", "\u2581", "a", "b", "ab"], [2, 3, 3, 1, 1, 1, 1]
    one, two = (Pieces(texts, [0, 0, 0, -1.0, -1.0, -1.0, x], kinds, False, False, True, True) for x in (-1.5, -9.0))
    assert in_process(one) is not in_process(two)
    assert [len(Transducer(m).encode("ab")) for m in (one, two)] == [2, 3]


def test_unigram_shortest_path():
    model = Pieces(["<unk>", "<s>", "</s>", "▁a", "▁ab", "b", "c", "bc", "▁"], [0, 0, 0, -1.0, -3.0, -1.5, -2.0, -2.4, -1.0], [2, 3, 3, 1, 1, 1, 1, 1, 1], False, False, True, True)
    assert [model.texts[i] for i in spm_fst.Transducer(model).encode("abc")] == ["▁a", "bc"]


def brute_metrics(t):
    t = t or ""
    w = [x for x in re.split("[ \t-\r]+", t) if x]
    g = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    cover = {j for i, x in enumerate(g) if g.count(x) > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in t.split("\n") if x.strip(WS)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(cover)


def test_quality(spark):
    rows = [(1, "a b c a b c a b c"), (2, None), (3, "x\n\nx\n \nx #|"), (4, "a a a a"), (5, " ".join(WORDS)), (6, " ".join(f"{w}***" for w in WORDS))]
    rows += [(i, " ".join(random.choice(WORDS) for _ in range(80))) for i in range(10, 40)]
    got = {r.doc_id: r for r in quality.quality_rules(frame(spark, rows)).collect()}
    for i, t in rows:
        r = got[i]
        assert (r.q_n_words, r.q_word_chars, r.q_n_symbols, r.q_n_dup_lines, r.q_n_repeat_words) == brute_metrics(t)
    assert not got[6].q_kept and got[6].q_reasons == ["symbols_per_word"] and all(got[i].q_kept for i in range(10, 40)) and got[2].q_base_failed
    assert quality.quality_rules(frame(spark, rows).limit(0)).count() == 0


def test_quality_follows_the_group(spark):
    rows = [(100 * g + i, " ".join(f"{w:x>{size}}" for w in random.sample(WORDS, 80)), lang, "s") for g, (lang, size) in enumerate((("a", 4), ("b", 9))) for i in range(20)]
    rows += [(900 + g, " ".join(f"{w:x>10}" for w in WORDS), lang, "s") for g, lang in enumerate("ab")]
    rows += [(1000 + i, " ".join(f"{w:x>{4 + i % 5}}" for w in WORDS), "c", "s") for i in range(20)] + [(902, rows[-1][1], "c", "s")]
    got = {r.doc_id: r for r in quality.quality_rules(frame(spark, rows), least_rows=20).collect()}
    assert got[900].q_reasons == ["word_chars_mean"] and [i for i, r in got.items() if not r.q_kept] == [900]


def test_quality_of_small_groups(spark):
    """A small group is judged by its language, a small language by all."""
    rows = [(i, " ".join(random.sample(WORDS, 80)), "a", "big") for i in range(30)]
    rows += [(100 + i, " ".join(f"{w:x>30}" for w in WORDS[:80]), "a", "one") for i in range(2)] + [(200, " ".join(f"{w:x>30}" for w in WORDS[:80]), "b", "one")]
    got = {r.doc_id: r.q_reasons for r in quality.quality_rules(frame(spark, rows), least_rows=20).collect()}
    assert {i for i, r in got.items() if r} == {100, 101, 200}
    docs = frame(spark, rows).withColumn("q_owner", F.lit("mine")).withColumn("q_kept", F.lit("old"))
    assert all(r.q_owner == "mine" and r.q_kept is True for r in quality.quality_rules(docs, least_rows=1).where("doc_id < 30").collect())


def test_sketches_merge(spark):
    values = [(random.choice("ab"), random.random() * 10) for _ in range(400)]
    df = spark.createDataFrame(values, "g string, v double")
    parts = quality.merge(quality.sketches(df.where("v < 5"), ["g"], ["v"]), quality.sketches(df.where("v >= 5"), ["g"], ["v"]), ["g"])
    for r in quality.quantiles(parts, ["g"], {"q": 0.75}).collect():
        own = sorted(v for g, v in values if g == r.g)
        assert abs(r.q - own[int(np.ceil(0.75 * len(own))) - 1]) <= 0.021 * r.q


def test_secrets(spark):
    key = "AKIA" + "A1B2" * 5
    strong = "q7Rz9Lm2Xv8Kt4Wb6Yh3Nc5Pd1Jf0Gs7Qa2Ze9Tx4"
    text = f'é token = "04dbebab91ab85687d33eeaaf9ac699e1188f962" {key} Secret=token:abcdefgh {strong} internationalisations'
    rows = [(1, text), (2, None), (3, ""), (4, "password: abc api_key=a:passwd=abcdef")]
    got = {r.doc_id: r for r in secrets.secret_scan(frame(spark, rows), fdr=0.05).collect()}
    assert (got[1].s_n_assign, got[1].s_n_access, got[1].s_n_hex) == (1, 1, 1)
    at = text.index(strong)
    assert f"random:{at}:{at + len(strong)}" in got[1].s_all and got[1].s_all.count("random") == 1
    assert got[2].s_base == got[3].s_base == "" and got[4].s_base == "assign:24:37"
    assert secrets.thresholds([(20, 50, 2), (20, 0, 1000)]) == {20: 50} and secrets.thresholds([(20, 10, 1), (20, 0, 1000)]) == {}


@pytest.mark.parametrize("rule", ["=" * 30, "x" + "=" * 19, "ab" + "=" * 30, "-" * 30])
def test_secrets_with_rules_under_headings(spark, rule):
    got = {r.doc_id: r.s_all for r in secrets.secret_scan(frame(spark, [(1, f"Title\n{rule}\ntext"), (2, f"{rule} password=abcdefgh")])).collect()}
    assert got == {1: "", 2: f"assign:{len(rule) + 1}:{len(rule) + 18}"}


def test_arc_round_trip(spark):
    recs = [({"url": "http://a.org/", "ip": "1.2.3.4", "date": "20010203040506", "type": "text/html"}, b"x\n\ny"), ({"url": "http://b.org/", "ip": "1.2.3.4", "date": "2001", "type": "t"}, b"")]
    for version in (1, 2):
        back = list(warc.parse_arc(warc.arc_bytes(version, "n.arc", recs)))
        assert [(f["url"], c) for f, c in back] == [(f["url"], c) for f, c in recs]
        raw = b"".join(warc.to_warc(f, c) + b"\r\n\r\n" for f, c in back)
        fields, block = next(warc.parse_warc(raw))
        assert block == b"x\n\ny" and fields["WARC-Date"] == "2001-02-03T04:05:06Z" and fields["WARC-Type"] == "resource"
    with pytest.raises(ValueError):
        list(warc.parse_arc(warc.arc_bytes(1, "n", recs)[:-5]))
    big = "<p>é\r\n\r\n" + "x" * 1000
    pages = spark.createDataFrame([(1, "http://a b", big), (2, None, big), (3, "u", "small"), (4, "u", "small"), (5, "u", None), (6, "u", big)], "page_id long, url string, html string")
    got = {r.page_id: r for r in warc.archive_pages(pages).collect()}
    assert {i: (r.record_type, r.refers_to) for i, r in got.items()} == {1: ("revisit", 6), 2: ("revisit", 6), 3: ("response", None), 4: ("response", None), 5: ("response", None), 6: ("response", None)}
    assert got[1].payload_digest == hashlib.sha1(big.encode()).hexdigest() and got[1].payload_bytes == len(big.encode()) and got[5].payload_bytes == 0
    assert warc.archive_pages(pages.limit(0)).count() == 0


def test_warc_references_resolve(spark, tmp_path):
    big = "x" * 1000
    pages = spark.createDataFrame([(i, f"http://a.org/{i}", big if i % 3 else "own" * 400 + str(i)) for i in range(30)] + [(None, None, big)], "page_id long, url string, html string")
    got = {r.page_id: r for r in warc.archive_pages(pages, str(tmp_path / "w")).collect()}
    rows = warc.read_records(spark, str(tmp_path / "w")).collect()
    known = {r.record_id: r for r in rows}
    revisits = [r for r in rows if r.record_type == "revisit"]
    assert len(known) == 31 and len(revisits) == 20 and all(known[r.refers].page_id == 29 and known[r.refers].record_type == "response" for r in revisits)
    assert all(got[r.page_id].refers_to == 29 and got[r.page_id].payload_bytes == 1000 for r in revisits)


def test_html(spark):
    menu = "<div><span>Home</span> <span>About us</span></div>"
    rows = [(i, "http://h.org/x", f"<body>{menu}<p>Own text {i} &amp; more</p></body>") for i in range(5)]
    rows += [(9, "http://h.org/y", '<nav>n</nav><article><h1>T</h1><p><b>A<br>b<p>c&nbsp;d<div class="comments">no</div><script>"</p>"</script></article><footer>f</footer>'), (10, None, None), (11, "u", "")]
    got = {r.id: (r.text, r.n_chars) for r in html_extract.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[3] == ("Own text 3 & more", 17) and got[9] == ("T A b c d", 9) and got[10] == got[11] == ("", 0)


def test_html_nesting_is_linear():
    import time

    began = time.perf_counter()
    blocks, parents, trees = html_extract.blocks_of("<div>a" * 100_000)
    assert len(blocks) == len(trees) == 100_000 and time.perf_counter() - began < 20
    blocks, parents, trees = html_extract.blocks_of("<div><p>x</p></div><div><p>x</p></div>")
    assert trees[0] == trees[2] != trees[1] == trees[3] and parents == [-1, 0, -1, 2] and [b[2] for b in blocks] == [1, 3]


def test_html_counts_decide_without_telling_names(spark):
    """Subtrees without a telling class, inside main, go by their counts alone: against a brute force of the host's counts."""
    rows = []
    for i in range(12):
        box = f"<div class='k{i % 2}'><b>Box of kind {i % 2}</b> <i>seen by all</i></div>" if i < 8 else ""
        rows.append((i, "http://h.org/x" if i != 3 else "http://other.org/x", f"<main><div>Strip of the site</div><p>Own text {i}.</p>{box}</main>"))
    got = {r.id: r.text for r in html_extract.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    hosts = {i: u for i, u, _ in rows}

    def held(part, host):
        return sum(part in h and u == host for _, u, h in rows)

    for i, u, _ in rows:
        n = sum(x == u for x in hosts.values())
        parts = ["Strip of the site", f"Own text {i}."] + ([f"Box of kind {i % 2} seen by all"] if i < 8 else [])
        keep = [p for p in parts if held(re.sub(" seen by all", "</b> <i>seen by all", p), u) < max(3, min(10, 0.3 * n))]
        assert got[i] == " ".join(keep)
    assert sum("Strip" in t for t in got.values()) == 1


def test_html_articles_are_a_hint(spark):
    links = "<ul><li><a href='/a'>First of the section</a></li><li><a href='/b'>Second of the section</a></li></ul>"
    body = "".join(f"<div>Paragraph {{i}} {k} of the text that the page is about.</div>" for k in range(3))
    rows = [(i, "http://h.org/x", f"<body>{body.format(i=i)}<article>Teaser {i}</article></body>") for i in range(5)]
    rows += [(10 + i, "http://k.org/x", f"<main><p>Text {i} of the main element.</p><div>Sign and win a prize</div></main>") for i in range(5)]
    rows += [(20 + i, "http://m.org/x", f"<div>Other {i}</div><article><p>Text {i} of the article.</p><p>A quoted line</p>{links}</article>") for i in range(5)]
    got = {r.id: r.text for r in html_extract.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[1] == " ".join(f"Paragraph 1 {k} of the text that the page is about." for k in range(3)) + " Teaser 1"
    assert got[11] == "Text 1 of the main element." and got[21] == "Text 1 of the article. A quoted line"


def test_html_sections_of_a_large_host(spark):
    rows = []
    for i in range(80):
        menu = f"<ul><li><a href='/a'>Menu of topic {i // 4}</a></li></ul>"
        quote = "<blockquote>Said by many</blockquote>" if i < 5 else ""
        rows.append((i, "http://h.org/x", f"<body>{menu}<div>Campaign of section {i // 16}</div><p>Own text {i}.</p>{quote}</body>"))
    got = {r.id: r.text for r in html_extract.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {i: f"Own text {i}." + (" Said by many" if i < 5 else "") for i in range(80)}


def test_toxicity(spark):
    docs = [(i, " ".join(random.choice(WORDS) for _ in range(20)) + (" rotten" if i % 3 == 0 else "")) for i in range(300)] + [(1000, None)]
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(300)], "doc_id long, toxic int")
    got = {r.id: r for r in toxicity.toxicity(frame(spark, docs), labels).collect()}
    held = [r for i, r in got.items() if r.held_out and i < 300]
    assert held and all(r.predicted == int(r.id % 3 == 0) for r in held) and got[1000].predicted == 0
    assert toxicity.counterfactuals("The Women, here") == ["the men, here"] and toxicity.counterfactuals("none") == []
    assert toxicity.counterfactuals("muslim men") == ["christian women", "jewish women", "hindu women"]
    texts = [f"women awful {w}" for w in WORDS[:40]] + [f"men fine {w}" for w in WORDS[:40]]
    y = np.array([1] * 40 + [0] * 40)
    gap = [toxicity.identity_gap(toxicity.train(texts, y, fairness=f)) for f in (0.0, 1.0, 10.0)]
    assert gap[2] < gap[1] < 0.5 * gap[0]
    # Conflicting labels of an id count as toxic, whatever their order.
    twice = labels.union(spark.createDataFrame([(i, 0) for i in range(300)], labels.schema))
    assert {r.id: r.score for r in toxicity.toxicity(frame(spark, docs), twice).collect()} == {i: r.score for i, r in got.items()}


def test_pipeline(spark, tmp_path):
    import corpus_pipeline

    body = [" ".join(random.choice(WORDS) for _ in range(100)) for _ in range(5)]
    rows = [(1, body[0]), (2, body[0] + " end"), (3, body[1]), (4, "too short"), (5, body[2] + " " + BENCH[0][1]), (6, body[3] + "\na line that is shared"), (7, body[4] + "\na line that is shared")]
    frame(spark, rows).withColumn("n_chars", F.length("text").cast("long")).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(BENCH, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    machine = Transducer(Pieces.load(model_path()))
    text = {i: machine.decode(r.ids) for i, r in got.items()}
    assert set(text) == {1, 3, 5, 6, 7} and text[5].strip() == body[2] and text[6].endswith("shared") and text[7] == body[4]


def test_odd_sketches_never_exceed_the_difference():
    import numpy as np

    from loomwell.llm.ngram_join import least_difference, odd_sketch

    rng = np.random.default_rng(3)
    for n, m, both in ((0, 0, 0), (0, 5, 0), (1, 1, 1), (60, 70, 60), (300, 310, 290), (900, 3000, 500)):
        pool = np.unique(rng.integers(0, 1 << 63, n + m + 9, dtype=np.uint64))
        a, b = pool[:n], pool[n - both : n - both + m]
        true = len(np.setxor1d(a, b))
        assert least_difference(odd_sketch(a), odd_sketch(b)) <= true
        assert least_difference(odd_sketch(a), odd_sketch(a)) == 0


LONG = " ".join(f"w{i % 977}" for i in range(60_000))


def every_operator(docs, bench, labels, pages):
    """(name, rows) of all ten operators over the same tables."""
    yield "secrets", secrets.secret_scan(docs)
    yield "lines", line_dedup(docs)
    yield "join", ngram_join(docs, sketch_bits=16)
    yield "tokens", token_counts(docs, model_path())
    yield "quality", quality.quality_rules(docs)
    yield "bench", decontaminate(docs, bench, clean=True)
    yield "bench, shuffled", decontaminate(docs, bench, clean=True, broadcast_windows=-1)
    yield "warc", warc.archive_pages(pages)
    yield "html", html_extract.extract(pages)
    yield "toxicity", toxicity.toxicity(docs, labels)
    yield "pieces", decode(encode(docs, model_path()).drop("sp_text"), model_path())


def test_every_operator_on_odd_rows(spark):
    """Nulls in every column, very long and repeated texts, extra columns of clashing names: a row for each row, equal rows alike."""
    clash = [F.lit(1).alias(c) for c in ("id", "sig", "key", "rep", "label", "n", "host", "page", "y", "s_all", "ld_text", "tc_n_tokens", "q_kept", "dc_items", "sp_ids", "f", "refers", "a", "b")]
    rows = [(1, LONG, "en", "s"), (2, LONG, "en", "s"), (2, LONG, "en", "s"), (3, None, None, None), (None, "a b c d e f", "en", None), (4, "", "", ""), (5, "\ud55c\U0001f600 " * 9, "ko", "t"), (6, "x", None, "s")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").select("*", *clash)
    bench = spark.createDataFrame([(1, "w5 w6 w7 w8 w9 w10 w11 w12 w13 w14 w15", 1), (None, None, 2), (None, "x", 3), (1, "", 4)], "item_id long, text string, doc_id int")
    labels = spark.createDataFrame([(1, 1, 1), (2, None, 0), (None, 1, None), (2, 0, 1)], "doc_id long, quality int, toxic int")
    pages = spark.createDataFrame([(1, "http://a.org", f"<p>{LONG}</p>"), (2, None, None), (2, None, None), (3, "::", "<p"), (None, "http://a.org", "x")], "page_id long, url string, html string").select("*", *clash)
    for name, out in every_operator(docs, bench, labels, pages):
        got = out.collect()
        assert len(got) == (5 if name in ("warc", "html") else 8), name
        twice = [r for r in got if 2 in (r.asDict().get("doc_id"), r.asDict().get("page_id"))]
        assert len({str(r) for r in twice}) <= 1, name


def test_every_operator_on_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string")
    bench, labels = spark.createDataFrame([], "item_id long, text string"), spark.createDataFrame([], "doc_id long, toxic int")
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    for name, out in every_operator(docs, bench, labels, pages):
        assert out.count() == 0 and out.columns, name


def brute_spans(text):
    text, out = text or "", []
    kinds = [("assign", r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 6), ("access", "AKIA[A-Z0-9]+", 0, 20), ("hex", "[0-9a-f]+", 0, 24)]
    for order, (kind, pattern, group, least) in enumerate(kinds):
        out += [(m.start(), order, f"{kind}:{m.start()}:{m.end()}") for m in re.finditer(pattern, text) if len(m[group]) >= least]
    return ",".join(x[2] for x in sorted(out))


def test_secrets_against_brute_force(spark):
    parts = ["password=", "Secret : '", "api_key\"= ", "token", "AKIA", "ABCD1234" * 3, "0a1b2c3d" * 4, "deadbeef", " ", "\n", "\u00e9\U0001f600", "x=", "====", "q7Rz9Lm2Xv8Kt4Wb6Yh3Nc5Pd1Jf0Gs7"]
    rows = [(i, "".join(random.choice(parts) for _ in range(random.randint(0, 40)))) for i in range(150)] + [(999, "ab " + "0123456789abcdef01234567 " * 2000)]
    got = {r.doc_id: r.s_base for r in secrets.secret_scan(frame(spark, rows)).collect()}
    assert got == {i: brute_spans(t) for i, t in rows}
