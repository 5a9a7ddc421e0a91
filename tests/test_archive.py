import gzip
import io

import pytest
from pyspark.sql import functions as F

from loomwell.functions.keywords import BOTH_SIDES, EITHER_SIDE, chunks, keyword_count, valid_chunks
from loomwell.operators import prepare, records, reports, search, shingles, topics
from loomwell.operators.stream_filter import StreamFilter
from loomwell.sources import fetch, ledger
from loomwell.sources.sinks import write_records
from loomwell.sources.wet import CORRUPT, NO_INFO, NORMAL, StepLimit, parse, parse_archives, read_wet


def one(spark, text, expr):
    return spark.createDataFrame([(text,)], "t string").select(expr.alias("x")).first()[0]


@pytest.mark.parametrize("text,word,policy,n", [
    ("asthmasthma", "asthma", 0, 2), ("Gun gunsmith shotgun", "gun", 0, 3), ("Gun gunsmith shotgun", "gun", BOTH_SIDES, 1),
    ("Gun gunsmith shotgun xguny", "gun", EITHER_SIDE, 3), ("gun-gun", "gun", BOTH_SIDES, 2), (None, "gun", 0, 0), ("", "gun", 0, 0), ("gun", "gun", 7, 0),
])
def test_keyword_count(spark, text, word, policy, n):
    assert one(spark, text, keyword_count(F.col("t"), word, policy)) == n


def test_chunks(spark):
    assert one(spark, "a b. c\nd", chunks(F.col("t"))) == ["a b", "c", "d"]
    assert one(spark, " ".join("a" * 7), F.size(valid_chunks(chunks(F.col("t"))))) == 0
    assert one(spark, " ".join("a" * 8), F.size(valid_chunks(chunks(F.col("t"))))) == 1
    assert one(spark, " ".join("a" * 50), F.size(valid_chunks(chunks(F.col("t"))))) == 0


def test_stream_filter(spark):
    rule = StreamFilter(("gun",), 2)
    assert one(spark, "a gun and a gun make two in one chunk here", rule.accepts(F.col("t")))
    assert not one(spark, "gun gun", rule.accepts(F.col("t")))
    assert not one(spark, None, rule.accepts(F.col("t")))


def test_topics(spark):
    assert one(spark, "Gun control is strict", topics.to_string(topics.FORUM_PRODUCTION.categories(F.col("t")))) == "{'guncontrol'}"
    assert one(spark, "nothing", topics.to_string(topics.FORUM.categories(F.col("t")))) == "{}"
    assert one(spark, "{}", topics.from_string(F.col("t"))) == []
    assert one(spark, "{'a','b'}", topics.from_string(F.col("t"))) == ["a", "b"]
    rows = topics.FORUM.counts(spark.createDataFrame([(1, "god guns atheist")], "id int, text string"), "id").collect()
    assert {r.topic: (r.core, r.secondary) for r in rows} == {"guncontrol": (2, 0), "abortion": (0, 0), "evolution": (0, 0), "existenceofgod": (1, 2)}
    with pytest.raises(ValueError):
        topics.FORUM.set_mentions("none", {"core": 1, "secondary": 1})
    with pytest.raises(ValueError):
        topics.FORUM.set_mentions("abortion", {"core": 1})


def brute_shingles(text):
    t, out = text.rstrip(" ").split(" "), []
    for i in range(0, len(t) - 5, 2):
        if t[i].lower() in shingles.STOPWORDS and " ".join(t[i : i + 6]) not in out:
            out.append(" ".join(t[i : i + 6]))
    return out


@pytest.mark.parametrize("text", ["the a b c d e", "x the b c d e f", "the a b c d", "a b the c d e f g  ", "the  a b c d e the  a b c d e", ""])
def test_shingles(spark, text):
    assert one(spark, text, shingles.Shingler().shingles(F.col("t"))) == brute_shingles(text)


def test_near_duplicate_corpus(spark):
    text = "the cat sat on a mat and was seen by the dog that is big"
    docs = spark.createDataFrame([(1, text), (2, text), (3, "no stop words here at all now"), (4, "the sun is up and a bird can sing to the old tree")], "id long, text string")
    sh = docs.select("id", shingles.Shingler().shingles(F.col("text")).alias("shingles"))
    hashes = shingles.min_hashes(sh, "id", "shingles")
    assert [tuple(r) for r in shingles.groups(hashes, "id").collect()] == [([1, 2], 1.0)]
    gone = shingles.discards(shingles.memberships(hashes, "id"), docs.select("id", F.lit(1.0).alias("relevance")), "id")
    assert [r.id for r in shingles.corpus(docs.select("id"), sh, gone, "id").orderBy("id").collect()] == [1, 4]


@pytest.fixture(scope="session")
def near_copies(spark):
    text = "the cat sat on a mat and was seen by the dog that is big"
    other = "the sun is up and a bird can sing to the old tree"
    return spark.createDataFrame([(1, text), (2, text + " and old"), (3, None), (4, other), (5, text), (6, other), (7, ""), (8, "the end")], "id long, text string")


def near_copy_parts(docs):
    sh = docs.select("id", shingles.Shingler().shingles(F.col("text")).alias("shingles"))
    members = shingles.memberships(shingles.min_hashes(sh, "id", "shingles"), "id")
    return sh, members, docs.select("id", F.length("text").cast("double").alias("relevance"))


def brute_sets(docs):
    import hashlib
    from collections import Counter

    texts = {r.id: brute_shingles(r.text or "") for r in docs.collect()}
    same = Counter()
    for i in range(64):
        by = {}
        for k, own in sorted(texts.items()):
            if own:
                by.setdefault(min(hashlib.md5(f"{i}|{s}".encode()).hexdigest() for s in own), []).append(k)
        same.update(tuple(v) for v in by.values() if len(v) > 1)
    return {k: n / 64 for k, n in same.items() if n / 64 > 0.10}


def best_of_sets(docs):
    size = {r.id: len(r.text or "") for r in docs.collect()}
    return {k: max(k, key=lambda x: (size[x], -x)) for k in brute_sets(docs)}


def test_near_duplicates_hash_once(spark, near_copies):
    sh, members, relevance = near_copy_parts(near_copies)
    hashes = shingles.min_hashes(sh, "id", "shingles")
    assert sorted(r.h for r in hashes.where("id = 1 AND i < 2").collect()) == sorted(r.h for r in hashes.where("id = 5 AND i < 2").collect())
    assert hashes.count() == 64 * 5
    found = shingles.groups(hashes, "id")
    assert {tuple(r.ids): r.similarity for r in found.collect()} == brute_sets(near_copies)
    gone = shingles.discards(members, relevance, "id")
    keep = best_of_sets(near_copies)
    assert {r.id for r in gone.collect()} == {x for k, best in keep.items() for x in k if x != best}
    # Shingles and their hashes are most of the work: they stand once in the plans.
    for df in (members, found, gone):
        plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
        assert plan.count("array_min(") == 1 and plan.count("array_distinct(") == 1, plan


def test_most_relevant_without_copied_arrays(spark, near_copies):
    from loomwell.plans import queries

    _, members, relevance = near_copy_parts(near_copies)
    best = shingles.most_relevant(members, relevance, "id")
    assert {tuple(r.ids): r.best for r in best.collect()} == best_of_sets(near_copies)
    # No row of a member carries its group's whole array.
    plan = queries.most_relevant_per_group(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "explode(ids" not in plan and plan.count("array_min(") == 1


def test_records_and_reports(spark):
    assert one(spark, "http://a.b.example.org:80/x", records.top_level_domain(F.col("t"))) == "org"
    assert one(spark, None, records.top_level_domain(F.col("t"))) is None
    led = spark.createDataFrame([("a", True, True), ("b", True, False), ("c", False, False)], "wet_path string, started boolean, finished boolean")
    r = reports.progress(led).first()
    assert (r.total, r.finished, r.remaining, r.errored, r.finished_pct) == (3, 1, 2, 1, 33.33)
    assert [x.wet_path for x in reports.incomplete(led).collect()] == ["b"]
    assert reports.progress(led.limit(0)).first().finished_pct is None
    merged = ledger.merge(led, spark.createDataFrame([("b", True), ("d", True)], "wet_path string, finished boolean"), ["wet_path"])
    assert {(x.wet_path, x.started, x.finished) for x in merged.collect()} == {("a", True, True), ("b", True, True), ("c", False, False), ("d", None, True)}


GOOD = "The old mill stood by the river for years. Nobody in the village knew who owned it."


@pytest.mark.parametrize("text,prepared", [
    (GOOD, GOOD), (None, ""), ("", ""), ("\n\n", ""), ("Menu\nHome\n" + GOOD + "\nContact", GOOD), ("Follow us\nPrint | Mail | 12\nNo replies yet", ""),
    # A line that breaks off goes on with the next one of prose, and with one line of a few words between them.
    ("The long road that led down to\nthe harbour was closed in winter.", "The long road that led down to\nthe harbour was closed in winter."),
    ("The long road that led down to\nthe harbour\nwas closed in every winter since then.", "The long road that led down to\nthe harbour\nwas closed in every winter since then."),
    ("The long road that led down to\none line\nand another\nwas closed in every winter since then.", ""),
    ("The coastal road was shut. Later on it led down to\n***\nHome", "The coastal road was shut."), ("The coastal road was shut. Later on it led down to\na b", "The coastal road was shut."),
    # What ends a sentence is kept within a block alone.
    ("Shut again.\nOther", ""), ("The long road that led down to the sea was\nshut again.\nshut again.", "The long road that led down to the sea was\nshut again."),
    # A line left out before a block that begins in small letters is its beginning.
    ("A road that\nled down to the sea was shut all winter.", "A road that\nled down to the sea was shut all winter."),
    ("A road that\nLed down to the sea was shut all winter.", "Led down to the sea was shut all winter."),
    ("A road that\nled down to the sea was shut all winter. but then", ""), ("a road that\nled down to the sea was shut all winter.", ""),
    ("One two three, 44 55 66 77 88.", ""), ("then it was over. Nobody spoke for a long time", ""), ("It is.\nIt is so.", ""),
    ("and so on. He asked: \"Who is there at the door?\" and then", "He asked: \"Who is there at the door?\""), ("and so they asked him. \"Who is there at the door?\" he said at last.", "\"Who is there at the door?\" he said at last."),
    ("Who paid for all of the repairs (Mr. Miller?) and who did not pay", "Who paid for all of the repairs (Mr. Miller?)"), ("word " * 70 + "The end came late.", ""),
    ("Nobody knows what happened to him... or when and why it did", ""),
])
def test_prepare(text, prepared):
    assert prepare.prepare_text(text) == prepared


def test_prepare_reads_words_once(monkeypatch):
    class Counting:
        read = 0

        def findall(self, text, found=prepare.TOKEN.findall):
            Counting.read += len(text)
            return found(text)

    lines = [("Some long road led down to the old harbour, and nobody in town knew why it was shut. " * 40).strip()] * 20
    monkeypatch.setattr(prepare, "TOKEN", Counting())
    assert prepare.prepare_text("\n".join(lines)) == "\n".join(lines)
    assert Counting.read < len("\n".join(lines)) // 5


def test_words_count_like_lines():
    line = "Mr. Ünal didn’t pay $3.50, the U.S. men's Ph.D. cost 12, 3. (x) A. B, Ö! ÷ 中文 a.b. e.g. and/or no. No. end... n't 'll \x1c\xa0é? ."
    for x in (line, *line.split(" ")):
        tokens = prepare.TOKEN.findall(x)
        total = sum(map(prepare._counts.__getitem__, x.split()))
        expected = [len(tokens), sum(prepare._MARKED.search(t) is not None for t in tokens), sum(prepare._DIGIT.search(t) is not None for t in tokens)]
        assert [total >> prepare._FIELD * i & (1 << prepare._FIELD) - 1 for i in range(3)] == expected


def test_prepare_parts(spark):
    assert prepare.clean_block("lower case then Some one met Dr. Smith at noon. and a tail") == "Some one met Dr. Smith at noon."
    assert prepare.tokenize('He said "no" (twice).') == ["He", "said", "``", "no", "''", "-LRB-", "twice", "-RRB-", "."]
    assert prepare.tokenize("Don\u2019t ask, they're the U.S. men's e.g.") == ["Do", "n\u2019t", "ask", ",", "they", "'re", "the", "U.S.", "men", "'s", "e.g."]
    assert [prepare.symbol(x) for x in ("a b c d e f g.", "a b c d e f", "so.", "two words", "word", "| *", "")] == ["E", "K", "e", "m", "x", "x", "x"]
    docs = spark.createDataFrame([(1, GOOD, "x"), (2, "Menu", "y"), (3, None, None)], "id long, text string, q string")
    assert [tuple(r) for r in prepare.prepare_documents(docs).collect()] == [(1, GOOD, "x")]
    assert prepare.prepare_documents(docs)._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1


def record(kind, body, n):
    head = {"WARC-Type": kind, "WARC-Date": "d", "WARC-Record-ID": f"id{n}", "Content-Type": "text/plain"}
    head |= {"WARC-Filename": "f"} if kind == "warcinfo" else {"WARC-Target-URI": "http://a.org", "WARC-Refers-To": "r", "WARC-Block-Digest": "x"}
    raw = body.encode()
    return ("WARC/1.0\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head.items()) + f"Content-Length: {len(raw)}\r\n\r\n").encode() + raw + b"\r\n\r\n"


def test_wet(spark, tmp_path):
    parts = [record("warcinfo", "info", 0), record("conversion", "text é", 1), record("conversion", "two\nlines", 2)]
    (tmp_path / "good.gz").write_bytes(b"".join(map(gzip.compress, parts)))
    (tmp_path / "bad.gz").write_bytes(gzip.compress(b"junk\n" * 30))
    # Header lines are looked for a limited number of times, so the record is given up within its own content.
    broken = record("conversion", "line\n" * 12, 1).replace(b"WARC-Date: d\r\n", b"")
    (tmp_path / "part.gz").write_bytes(gzip.compress(parts[0] + broken + parts[2]))
    rows = read_wet(spark, str(tmp_path)).collect()
    by = {name: [r for r in rows if r.wet_path.endswith(name)] for name in ("good.gz", "bad.gz", "part.gz")}
    assert [r.content for r in by["good.gz"]] == ["text é", "two\nlines", None] and by["good.gz"][-1].log_message == NORMAL
    assert [r.log_message for r in by["bad.gz"]] == [NO_INFO]
    assert [r.content for r in by["part.gz"]] == ["two\nlines", None] and by["part.gz"][-1].log_message == CORRUPT
    assert ledger.outcomes(read_wet(spark, str(tmp_path))).count() == 3
    assert by["good.gz"][0].info["WARC-Filename"] == "f"


@pytest.mark.parametrize("where", ["before", "after"])
def test_wet_keeps_records_with_more_fields(where):
    for n in range(21):
        more = b"".join(b"X-%d: y\r\n" % i for i in range(n))
        one = record("conversion", "text", 1)
        one = one.replace(b"\r\n\r\n", b"\r\n" + more + b"\r\n", 1) if where == "after" else one.replace(b"WARC-Type", more + b"WARC-Type", 1)
        rows = list(parse(io.BytesIO(record("warcinfo", "info", 0) + one + record("conversion", "next", 2))))
        assert [r[2] for r in rows] == ["text", "next", None] and rows[-1][5] == NORMAL


def test_wet_damaged_anywhere(spark):
    whole = b"".join(gzip.compress(record(k, "text of some length", i)) for i, k in enumerate(("warcinfo", "conversion")))
    damaged = [(str(i), bytearray(whole[:i] + bytes([whole[i] ^ 0x55]) + whole[i + 1 :])) for i in range(len(whole))]
    rows = parse_archives(spark.createDataFrame(damaged, "path string, content binary")).where("log_message IS NOT NULL").groupBy("wet_path").count().collect()
    assert len(rows) == len(whole) and all(r["count"] == 1 for r in rows)


def test_wet_edges(spark):
    with pytest.raises(StepLimit):
        list(parse(io.BytesIO(record("warcinfo", "info", 0) + record("conversion", "text", 1)), step_limit=12))
    assert [r[5] for r in parse(io.BytesIO(record("conversion", "text", 1)))] == [NO_INFO] and [r[5] for r in parse(io.BytesIO(b""))] == [NO_INFO]
    info = record("warcinfo", "info", 0)
    assert list(parse(io.BytesIO(info)))[-1][5] == NORMAL
    assert list(parse(io.BytesIO(info + record("conversion", "text", 1)[:-9])))[0][3]
    assert [r[2] for r in parse(io.BytesIO(info + record("response", "text", 1) + record("conversion", "next", 2)))] == ["next", None]


def test_archives_and_their_parser_hold_little(spark):
    import random

    from loomwell.plans import queries

    # Hardly compressible texts, all in one Arrow batch.
    chars = [chr(i) for i in range(33, 127)]
    texts = [(i, "".join(random.Random(i).choices(chars, k=300_000))) for i in range(30)] + [(30, None), (31, "")]
    archives = queries._archives(spark.createDataFrame(texts, "doc_id long, text string").coalesce(1)).cache()
    sizes = [r[0] for r in archives.select(F.octet_length("content")).collect()]
    assert len(sizes) > 2 and max(sizes) < queries.ARCHIVE_BYTES + 300_000 and archives.select("path").distinct().count() == len(sizes)
    rows = parse_archives(archives).collect()
    assert {int(r.warc_record_id): r.content for r in rows if r.warc_record_id} == {i: t or "" for i, t in texts}
    assert [r.log_message for r in rows if not r.warc_record_id] == [NORMAL] * len(sizes)
    archives.unpersist()


def test_record_sink(spark, tmp_path):
    rows = [("<urn:uuid:0a0a0a0a-1111-2222-3333-444444444444>", "org", 0.5, "p/w.gz", "a\nb"), ("x", None, None, None, None)]
    write_records(spark.createDataFrame(rows, "warc_record_id string, warc_tldn string, relevance double, wet_path string, content string"), str(tmp_path / "out"))
    found = {p.parent.name: p.read_text() for p in (tmp_path / "out").glob("record=*/*.txt")}
    assert found == {"record=org-0a0a0a0a-1111-2222-3333-444444444444": "URL: p/w.gz\nTop Level Domain Name: org\nRelevance: 0.5\n\na\nb\n", "record=none-x": "URL: \nTop Level Domain Name: \nRelevance: \n\n\n"}


def test_search_terms(spark):
    docs = spark.createDataFrame([(1, "Pro-life and pro life; pro-lifer"), (2, "life's o'clock"), (3, None), (4, "")], "id long, text string")
    tf = lambda terms: sorted(r.id for r in search.relevance(docs, terms, "id").collect())
    assert tf(["pro-life"]) == [1] and tf(["o'clock"]) == [2] and tf(["lifer", "life"]) == [1, 2] and tf(["--"]) == []


def test_older_variant(spark):
    text = "He said (twice) that it's over, and the U.S. men weren't there at noon."
    tokens = prepare.TOKEN.findall(text)
    expected = {" ".join(tokens[i : i + 9]) for i in range(len(tokens) - 8) if tokens[i].lower() in shingles.ENGLISH_STOPWORDS}
    assert expected and set(one(spark, text, shingles.OLDER.shingles(F.col("t")))) == expected and one(spark, None, shingles.OLDER.shingles(F.col("t"))) == []
    docs = spark.createDataFrame([(1, ["b", "a"]), (2, ["a", "c"]), (3, []), (4, None)], "id long, s array<string>")
    space = shingles.feature_space(docs, "s")
    index = {r["shingle"]: r["index"] for r in space.collect()}
    assert sorted(index.values()) == [0, 1, 2]
    assert {r.id: r.indices for r in shingles.feature_vectors(docs, space, "id", "s").collect()} == {1: sorted([index["a"], index["b"]]), 2: sorted([index["a"], index["c"]]), 3: [], 4: []}
    found = spark.createDataFrame([(1, "x"), (2, "x"), (3, "y"), (4, "x")], "id long, bucket string")
    rel = spark.createDataFrame([(1, 0.5), (2, 0.9), (3, 0.1), (4, 0.9)], "id long, relevance double")
    assert {tuple(r) for r in shingles.bucket_duplicates(found, rel, "id").collect()} == {("x", 1, 2), ("x", 2, 2), ("x", 4, 2)}


def test_treebank_shingles_without_slow_steps(spark):
    from loomwell.plans import queries

    # Stop-words as a set, and no comparison of strings by an interpreted function.
    for q in (queries.shingle_treebank, queries.shingle_nine, queries.shingle_stats):
        plan = q(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
        assert "INSET" in plan and "sort_array(" in plan and "array_contains(" not in plan and "array_sort(" not in plan
    # Words that the pattern's first alternative takes, or must leave to the others.
    line = "Prof. Ünal's U.S. team can't pay 3.5, e.g. and/or the rock'n'roll x@y.z don\u2019t \u2019tis end. No. 7 a.m. Mr (Mr.) it's n't Jan ... co. co"
    assert one(spark, line, shingles.treebank_tokens(F.col("t"))) == [
        "Prof.", "Ünal", "'s", "U.S.", "team", "ca", "n't", "pay", "3.5", ",", "e.g.", "and/or", "the", "rock'n'roll", "x@y.z", "do", "n\u2019t", "\u2019", "tis", "end", ".", "No.", "7",
        "a.m.", "Mr", "(", "Mr.", ")", "it", "'s", "n't", "Jan", "...", "co", ".", "co",
    ]


def test_text_parts(spark):
    assert one(spark, "One. Two?  Three! x.y\nz.", prepare.sentences(F.col("t"))) == ["One.", "Two?", "Three!", "x.y\nz."] and one(spark, None, prepare.sentences(F.col("t"))) == []
    import hashlib

    zero = next(str(i) for i in range(10000) if hashlib.md5(str(i).encode()).hexdigest().startswith("00"))
    assert one(spark, zero + "\na", prepare.line_hashes(F.col("t"))) == [format(int(hashlib.md5(x.encode()).hexdigest(), 16), "x") for x in (zero, "a")]
    assert one(spark, "a", reports.common_categories(F.array(F.lit("b"), F.lit("a")), ["a", "b", "c"])) == ["a", "b"] and one(spark, "a", reports.common_categories(F.array(F.lit("b")), [])) == []


def test_ledger(spark, tmp_path):
    led = spark.createDataFrame([("a", False, "m"), ("b", False, "n")], "wet_path string, started boolean, log_message string")
    begun = {r.wet_path: r for r in ledger.begin(led, spark.createDataFrame([("b",), ("b",)], "wet_path string")).collect()}
    assert begun["b"].started and begun["b"].started_processing is not None and begun["b"].log_message == "n" and not begun["a"].started and begun["a"].started_processing is None
    added = ledger.append(led, spark.createDataFrame([("a", None), ("c", "z")], "wet_path string, log_message string"), ["wet_path"])
    assert {tuple(r) for r in added.collect()} == {("a", False, None), ("b", False, "n"), ("c", None, "z")}
    led.write.parquet(str(tmp_path / "t"))
    ledger.truncate(spark, str(tmp_path / "t"))
    again = spark.read.parquet(str(tmp_path / "t"))
    assert again.count() == 0 and again.columns == led.columns
    (tmp_path / "w.txt").write_text("a\nb")
    assert [r.text for r in fetch.read_whole(spark, str(tmp_path / "w.txt")).collect()] == ["a\nb"]


def test_fetch(spark):
    import threading
    from http.server import BaseHTTPRequestHandler, HTTPServer

    asked, archive = [], gzip.compress(record("warcinfo", "info", 0) + record("conversion", "text", 1))

    class Handler(BaseHTTPRequestHandler):
        def do_GET(self):
            asked.append(self.path)
            code = 404 if self.path == "/none" else 503 if self.path == "/always" or asked.count(self.path) == 1 else 200
            self.send_response(code)
            self.end_headers()
            if code == 200:
                self.wfile.write(archive)

        def log_message(self, *args):
            pass

    server = HTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    paths = spark.createDataFrame([("/w",), ("/none",), ("/always",), (None,)], "wet_path string")
    got = fetch.fetch(paths, f"http://127.0.0.1:{server.server_port}", pause=0.01, stagger=0.0, tasks=1).collect()
    server.shutdown()
    assert {r.path: r.error for r in got} == {"/w": None, "/none": "HTTP 404", "/always": "HTTP 503", None: "no path"}
    assert asked.count("/w") == 2 and asked.count("/none") == 1 and asked.count("/always") == 3
    rows = parse_archives(spark.createDataFrame([(r.path, r.content) for r in got if r.content], "path string, content binary")).collect()
    assert [r.content for r in rows] == ["text", None]


def test_entry_points():
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries()) and len(e.queries()) > 30
