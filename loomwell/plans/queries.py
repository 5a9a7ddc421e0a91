"""Queries over the test tables for the archive-corpus operators, and the SQL that they are held against.

The test texts are invented, so the lexicon here has words that occur in them; the presets of the operators are other.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomwell.functions.keywords import BOTH_SIDES, EITHER_SIDE, keyword_count, once
from loomwell.operators import prepare, records, reports, search, shingles, topics
from loomwell.operators.stream_filter import StreamFilter, stats
from loomwell.sources import wet

LEXICON = topics.Topics(
    {
        "conjunction": {"core": ("and", "und"), "secondary": ("hand", "what")},
        "article": {"core": ("the", "der"), "secondary": ("then", "there")},
        "spanish": {"core": ("que",), "secondary": ("para", "las")},
    },
    {"conjunction": {"core": 2, "secondary": 1}, "article": {"core": 1, "secondary": 1}, "spanish": {"core": 3, "secondary": 1}},
)
SEPARATED = topics.Topics(LEXICON.lexicon, LEXICON.mentions, {t: {"core": BOTH_SIDES, "secondary": EITHER_SIDE} for t in LEXICON.lexicon})
RULE = StreamFilter(("there", "then"), 2)
KEYWORDS = ("and", "der", "gun")
SINGLE = {"and": "english", "the": "english", "der": "german"}
TERMS = ["there", "hand", "gun"]
NAMES = sorted(LEXICON.lexicon)


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def keyword_counts(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", *[keyword_count(F.col("text"), k).cast("long").alias(f"n_{k}") for k in KEYWORDS])


def keyword_separators(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", keyword_count(F.col("text"), "and", BOTH_SIDES).cast("long").alias("n_both"), keyword_count(F.col("text"), "and", EITHER_SIDE).cast("long").alias("n_either"))


def stream_filter(spark, sf_dir):
    return _docs(spark, sf_dir).where(RULE.accepts(F.col("text"))).select("doc_id", "source")


def stream_filter_stats(spark, sf_dir):
    out = stats(_docs(spark, sf_dir), RULE)
    return out.select("doc_id", *[F.col(c).cast("long") for c in ("accepted", "rejected_in_detail", "rejected_early", "n_chunks", "n_valid_chunks")])


def topic_counts(spark, sf_dir):
    return LEXICON.counts(_docs(spark, sf_dir), "doc_id").select("doc_id", "topic", F.col("core").cast("long"), F.col("secondary").cast("long"))


def topic_categories(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", topics.to_string(LEXICON.categories(F.col("text"))).alias("categories"))


def topic_single_keyword(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", F.array_join(topics.single_keyword_categories(F.col("text"), SINGLE), ",").alias("categories"))


def category_string_parse(spark, sf_dir):
    own = _docs(spark, sf_dir).select("doc_id", topics.to_string(LEXICON.categories(F.col("text"))).alias("s"))
    return own.select("doc_id", F.array_join(topics.from_string(F.col("s")), "|").alias("parsed"))


def docs_per_topic(spark, sf_dir):
    """The first query end to end: filter, classify, report."""
    kept = _docs(spark, sf_dir).where(RULE.accepts(F.col("text"))).select("doc_id", LEXICON.categories(F.col("text")).alias("categories"))
    return reports.docs_per_category(kept, "categories", NAMES).withColumn("docs", F.col("docs").cast("long"))


def url_tld(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", records.top_level_domain(F.col("url")).alias("tld"))


def docs_per_tld(spark, sf_dir):
    return url_tld(spark, sf_dir).groupBy("tld").agg(F.count("*").alias("docs"))


def distinct_records(spark, sf_dir):
    return reports.distinct_records(spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id").union(_docs(spark, sf_dir).select("doc_id")), "doc_id")


def doc_lengths(spark, sf_dir):
    return reports.content_lengths(_docs(spark, sf_dir), "doc_id", "text").withColumn("content_length", F.col("content_length").cast("long"))


def length_band(spark, sf_dir):
    return doc_lengths(spark, sf_dir).where(F.col("content_length").between(500, 80000))


def _ledger(spark, sf_dir):
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    return orders.select(F.col("o_orderkey").alias("wet_path"), (F.col("o_orderstatus") != "O").alias("started"), (F.col("o_orderstatus") == "F").alias("finished"))


def ledger_progress(spark, sf_dir):
    return reports.progress(_ledger(spark, sf_dir))


def ledger_incomplete(spark, sf_dir):
    return reports.incomplete(_ledger(spark, sf_dir)).select("wet_path")


def random_paths(spark, sf_dir):
    return reports.unfinished_sample(_ledger(spark, sf_dir), 10).select("wet_path")


def subword_counts(spark, sf_dir):
    return reports.subword_counts(_docs(spark, sf_dir), "tion")


def _shingles(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", shingles.Shingler().shingles(F.col("text")).alias("shingles"))


def shingle_stats(spark, sf_dir):
    return _shingles(spark, sf_dir).select("doc_id", F.size("shingles").cast("long").alias("n"), F.md5(F.array_join(F.sort_array("shingles"), "|")).alias("digest"))


def _relevance(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", F.length("text").cast("double").alias("relevance"))


def _groups(spark, sf_dir):
    return shingles.groups(shingles.min_hashes(_shingles(spark, sf_dir), "doc_id", "shingles"), "doc_id")


def _members(spark, sf_dir):
    return shingles.memberships(shingles.min_hashes(_shingles(spark, sf_dir), "doc_id", "shingles"), "doc_id")


def minhash_groups(spark, sf_dir):
    return _groups(spark, sf_dir).select(F.array_join("ids", ",").alias("ids"), F.round("similarity", 6).alias("similarity"))


def near_dup_discards(spark, sf_dir):
    return shingles.discards(_members(spark, sf_dir), _relevance(spark, sf_dir), "doc_id")


def most_relevant_per_group(spark, sf_dir):
    best = shingles.most_relevant(_members(spark, sf_dir), _relevance(spark, sf_dir), "doc_id")
    return best.select(F.array_join("ids", ",").alias("ids"), "best")


def deduped_corpus(spark, sf_dir):
    return shingles.corpus(_docs(spark, sf_dir).select("doc_id", "source"), _shingles(spark, sf_dir), near_dup_discards(spark, sf_dir), "doc_id")


def minhash_buckets(spark, sf_dir):
    hashes = shingles.min_hashes(_shingles(spark, sf_dir), "doc_id", "shingles", 5)
    return shingles.buckets(hashes, "doc_id").groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")


def _buckets(spark, sf_dir):
    return shingles.buckets(shingles.min_hashes(_shingles(spark, sf_dir), "doc_id", "shingles", 5), "doc_id")


def bucket_duplicates(spark, sf_dir):
    return shingles.bucket_duplicates(_buckets(spark, sf_dir), _relevance(spark, sf_dir), "doc_id")


def bucket_corpus(spark, sf_dir):
    """The most relevant document of each bucket."""
    return shingles.best_of(_buckets(spark, sf_dir), _relevance(spark, sf_dir), "bucket", "doc_id").select("bucket", "best")


def shingle_nine(spark, sf_dir):
    rule = shingles.Shingler(9, 1, shingles.ENGLISH_STOPWORDS)
    own = _docs(spark, sf_dir).select("doc_id", rule.shingles(F.col("text")).alias("s"))
    return own.select("doc_id", F.size("s").cast("long").alias("n"), F.md5(F.array_join(F.sort_array("s"), "|")).alias("digest"))


def shingle_treebank(spark, sf_dir):
    own = _docs(spark, sf_dir).select("doc_id", shingles.OLDER.shingles(F.col("text")).alias("s"))
    return own.select("doc_id", F.size("s").cast("long").alias("n"), F.md5(F.array_join(F.sort_array("s"), "|")).alias("digest"))


def feature_space(spark, sf_dir):
    return shingles.feature_space(_shingles(spark, sf_dir), "shingles").select("shingle", F.col("index").cast("long"))


def feature_space_size(spark, sf_dir):
    return shingles.feature_space(_shingles(spark, sf_dir), "shingles").agg(F.count("*").alias("features"))


def feature_vectors(spark, sf_dir):
    docs = _shingles(spark, sf_dir)
    own = shingles.feature_vectors(docs, shingles.feature_space(docs, "shingles"), "doc_id", "shingles")
    return own.select("doc_id", F.array_join("indices", ",").alias("indices"))


def topic_stats(spark, sf_dir):
    return topics.topic_stats(_docs(spark, sf_dir), LEXICON, "doc_id")


def category_overlap(spark, sf_dir):
    """Documents of at least one of two categories, and which."""
    own = once(_docs(spark, sf_dir).select("doc_id", "text"), "c", reports.common_categories(LEXICON.categories(F.col("text")), ["article", "spanish"]))
    return own.where(F.size("c") > 0).select("doc_id", F.array_join("c", ",").alias("common"))


def first_paths(spark, sf_dir):
    return reports.first_paths(_ledger(spark, sf_dir), 10)


def line_hashes(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", F.array_join(prepare.line_hashes(F.col("text")), ",").alias("hashes"))


def sentences(spark, sf_dir):
    own = _docs(spark, sf_dir).select("doc_id", prepare.sentences(F.col("text")).alias("s"))
    return own.select("doc_id", F.size("s").cast("long").alias("n"), F.md5(F.array_join("s", "|")).alias("digest"))


def search_topk(spark, sf_dir):
    return search.top(search.relevance(_docs(spark, sf_dir), TERMS, "doc_id"), "doc_id", 50)


def search_ranking(spark, sf_dir):
    return search.top(search.relevance(_docs(spark, sf_dir), TERMS, "doc_id"), "doc_id")


def corpus_join(spark, sf_dir):
    own = search.with_content(search_topk(spark, sf_dir), _docs(spark, sf_dir), "doc_id")
    return own.select("doc_id", "relevance", F.md5("text").alias("text_md5"))


def refiltered(spark, sf_dir):
    """Categories recomputed under separator policies; documents that have none go."""
    own = once(_docs(spark, sf_dir).select("doc_id", "text"), "c", SEPARATED.categories(F.col("text"))).where(F.size("c") > 0)
    return own.select("doc_id", topics.to_string(F.col("c")).alias("categories"))


def quality_corpus(spark, sf_dir):
    """The stand-in for the external classifier's kept set: labelled documents of quality 1."""
    kept = spark.read.parquet(f"{sf_dir}/labels.parquet").where("quality = 1").select("doc_id")
    return _docs(spark, sf_dir).join(kept, "doc_id", "left_semi").select("doc_id", "lang")


def prepare_documents(spark, sf_dir):
    return prepare.prepare_documents(_docs(spark, sf_dir).select("doc_id", "text"))


#: Bytes of compressed records that close an archive; a worker holds one archive besides its Arrow batch.
ARCHIVE_BYTES = 1 << 21


def _archives(docs):
    """(path, content): the documents as WET archives, a gzip member for each record; an archive ends with its Arrow batch or ARCHIVE_BYTES."""
    import gzip

    import pyarrow as pa

    def record(fields: dict, body: str) -> bytes:
        raw = body.encode()
        head = "".join(f"{k}: {v}\r\n" for k, v in fields.items())
        return gzip.compress(f"WARC/1.0\r\n{head}Content-Type: text/plain\r\nContent-Length: {len(raw)}\r\n\r\n".encode() + raw + b"\r\n\r\n", 1)

    info = record({"WARC-Type": "warcinfo", "WARC-Date": "2024-01-01T00:00:00Z", "WARC-Filename": "documents.wet.gz", "WARC-Record-ID": "<info>"}, "made of documents")

    def run(batches):
        for batch in batches:
            first, out = None, bytearray(info)
            for k in range(batch.num_rows):
                i, text = batch.column(0)[k].as_py(), batch.column(1)[k].as_py()
                first = i if first is None else first
                more = {f"X-Field-{j}": str(j) for j in range(i % 9)}
                out += record({"WARC-Type": "conversion", "WARC-Target-URI": f"http://h{i % 7}.example.org/{i}", "WARC-Date": "2024-01-01T00:00:00Z", "WARC-Record-ID": str(i), "WARC-Refers-To": "<none>", "WARC-Block-Digest": "none", **more}, text or "")
                if len(out) >= ARCHIVE_BYTES or k == batch.num_rows - 1:
                    yield pa.RecordBatch.from_arrays([pa.array([f"{first}.wet.gz"]), pa.array([bytes(out)], pa.binary())], ["path", "content"])
                    first, out = None, bytearray(info)

    return docs.select("doc_id", "text").mapInArrow(run, "path string, content binary")


def wet_parse(spark, sf_dir):
    """All documents written as WET archives and parsed again; records have 0 to 8 fields beyond the required ones."""
    rows = wet.parse_archives(_archives(_docs(spark, sf_dir))).where("warc_record_id IS NOT NULL")
    return rows.select(
        F.col("warc_record_id").cast("long").alias("doc_id"), F.md5("content").alias("content_md5"), records.content_bytes(F.col("headers")).cast("long").alias("content_bytes"),
        records.top_level_domain(records.get_field(F.col("headers"), F.col("info"), "WARC-Target-URI")).alias("tld"), records.get_field(F.col("headers"), F.col("info"), "WARC-Filename").alias("file_name"),
        records.is_complete(F.map_concat("headers", F.create_map(F.lit("Content"), F.col("content"))), records.CONVERSION_FIELDS, F.col("info")).alias("complete"),
    )


def substring_filter(spark, sf_dir):
    return _docs(spark, sf_dir).where(F.col("text").contains("gun")).select("doc_id")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        docs_per_topic, keyword_counts, keyword_separators, stream_filter, stream_filter_stats, topic_counts, topic_categories, topic_single_keyword,
        category_string_parse, refiltered, url_tld, docs_per_tld, distinct_records, doc_lengths, length_band, ledger_progress, ledger_incomplete,
        random_paths, subword_counts, shingle_stats, minhash_groups, minhash_buckets, near_dup_discards, most_relevant_per_group, deduped_corpus,
        search_topk, search_ranking, corpus_join, quality_corpus, prepare_documents, substring_filter, wet_parse,
        bucket_duplicates, bucket_corpus, shingle_nine, shingle_treebank, feature_space, feature_space_size, feature_vectors, topic_stats,
        category_overlap, first_paths, line_hashes, sentences,
    )
}


def _n(word: str) -> str:
    """Occurrences of a word that can't overlap itself."""
    return f"len(regexp_extract_all(lower(text), '{word}'))"


def _sum(words) -> str:
    return " + ".join(map(_n, words))


_CHUNKS = "flatten(list_transform(string_split(text, chr(10)), lambda l: string_split_regex(l, '\\. ')))"
_VALID = f"list_filter({_CHUNKS}, lambda c: len(list_filter(string_split(c, ' '), lambda w: w <> '')) BETWEEN 8 AND 49)"
_EARLY = f"({_n('there')} >= 2 OR {_n('then')} >= 2)"
_ACCEPT = f"({_EARLY} AND len(list_filter({_VALID}, lambda c: regexp_matches(lower(c), 'there|then'))) > 0)"
_MET = {t: f"({_sum(k['core'])}) >= {LEXICON.least(t, 'core')} AND ({_sum(k['secondary'])}) >= {LEXICON.least(t, 'secondary')}" for t, k in LEXICON.lexicon.items()}
_CATEGORIES = "list_filter([" + ", ".join(f"CASE WHEN {_MET[t]} THEN '{t}' END" for t in NAMES) + "], lambda c: c IS NOT NULL)"
_STRING = "CASE WHEN len(c) > 0 THEN '{''' || array_to_string(c, ''',''') || '''}' ELSE '{}' END"
# Both sides are consumed here, so separators are doubled first; every match then has its own.
_SEP = r"[\s!-/:-@\[-`{-~]"
_PAD = f"' ' || regexp_replace(lower(text), '({_SEP})', '\\1\\1', 'g') || ' '"
_BOTH = f"len(regexp_extract_all({_PAD}, '{_SEP}WORD{_SEP}'))"
_EITHER = f"(len(regexp_extract_all({_PAD}, '{_SEP}WORD')) + len(regexp_extract_all({_PAD}, 'WORD{_SEP}')) - len(regexp_extract_all({_PAD}, '{_SEP}WORD{_SEP}')))"


def _separated(t: str) -> str:
    core = " + ".join(_BOTH.replace("WORD", w) for w in LEXICON.lexicon[t]["core"])
    secondary = " + ".join(_EITHER.replace("WORD", w) for w in LEXICON.lexicon[t]["secondary"])
    return f"CASE WHEN ({core}) >= {LEXICON.least(t, 'core')} AND ({secondary}) >= {LEXICON.least(t, 'secondary')} THEN '{t}' END"


def _shingles_sql(size: int, stride: int, stopwords: tuple[str, ...]) -> str:
    stop = "[" + ", ".join(f"'{w}'" for w in stopwords) + "]"
    return f"""sh AS (
  SELECT doc_id, list_distinct(list_transform(
      list_filter(range(0, greatest(len(t) - {size - 1}, 0), {stride}), lambda i: list_contains({stop}, lower(t[i + 1]))),
      lambda i: array_to_string(t[i + 1:i + {size}], ' '))) AS shingles
  FROM (SELECT doc_id, string_split(rtrim(text, ' '), ' ') AS t FROM documents))"""


_SHINGLES = _shingles_sql(6, 2, shingles.STOPWORDS)
_NINE = _shingles_sql(9, 1, shingles.ENGLISH_STOPWORDS)
_SPACE = f"""{_SHINGLES}, one AS (SELECT DISTINCT unnest(shingles) AS shingle FROM sh),
  space AS (SELECT shingle, row_number() OVER (ORDER BY substr(md5(shingle), 1, {shingles.SPACE_DIGITS}), shingle) - 1 AS index FROM one)"""


def _hashes(n: int) -> str:
    return f"""{_SHINGLES},
  one AS (SELECT doc_id, unnest(shingles) AS s FROM sh),
  mh AS (SELECT doc_id, i, min(md5(i || '|' || s)) AS h FROM one, range(0, {n}) r(i) GROUP BY doc_id, i)"""


_GROUPS = f"""{_hashes(64)},
  g AS (SELECT i, h, list_sort(list(doc_id)) AS ids FROM mh GROUP BY i, h HAVING count(*) > 1),
  gr AS (SELECT ids, count(*) / 64.0 AS similarity FROM g GROUP BY ids HAVING count(*) / 64.0 > 0.10),
  m AS (SELECT ids, unnest(ids) AS doc_id FROM gr),
  ranked AS (SELECT m.ids, m.doc_id, row_number() OVER (PARTITION BY m.ids ORDER BY length(d.text) DESC, m.doc_id) AS rn FROM m JOIN documents d USING (doc_id))"""
_BUCKETS = f"""{_hashes(5)}, b AS (SELECT doc_id, min(h) AS bucket FROM mh GROUP BY doc_id),
  r AS (SELECT bucket, doc_id, count(*) OVER (PARTITION BY bucket) AS n, first_value(doc_id) OVER (PARTITION BY bucket ORDER BY length(text) DESC, doc_id) AS best FROM b JOIN documents USING (doc_id))"""
_TF = ", ".join(f"len(list_filter(w, lambda x: x = '{t}')) AS tf{i}" for i, t in enumerate(TERMS))
_SCORE = " + ".join(f"ln(1 + (n - df{i} + 0.5) / (df{i} + 0.5)) * tf{i} * 2.2 / (tf{i} + 1.2 * (0.25 + 0.75 * len / mean))" for i in range(len(TERMS)))
_SEARCH = f"""words AS (SELECT doc_id, list_filter(string_split_regex(lower(text), '[^a-z]+'), lambda w: w <> '') AS w FROM documents),
  own AS (SELECT doc_id, len(w) AS len, {_TF} FROM words),
  total AS (SELECT count(*) AS n, avg(len) AS mean, {', '.join(f'count(*) FILTER (tf{i} > 0) AS df{i}' for i in range(len(TERMS)))} FROM own),
  scored AS (SELECT doc_id, round({_SCORE}, 6) AS relevance FROM own, total WHERE greatest({', '.join(f'tf{i}' for i in range(len(TERMS)))}) > 0)"""
_LEDGER = "led AS (SELECT o_orderkey AS wet_path, o_orderstatus <> 'O' AS started, o_orderstatus = 'F' AS finished FROM orders)"
_HOST = "nullif(regexp_extract(url, '^[a-z]+://(?:[^/?#@]*@)?([^/?#:]+)', 1), '')"
_TLD = f"string_split({_HOST}, '.')[-1]"

ORACLE: dict[str, str] = {
    "keyword_counts": "SELECT doc_id, " + ", ".join(f"{_n(k)} AS n_{k}" for k in KEYWORDS) + " FROM documents",
    "keyword_separators": f"SELECT doc_id, {_BOTH.replace('WORD', 'and')} AS n_both, {_EITHER.replace('WORD', 'and')} AS n_either FROM documents",
    "stream_filter": f"SELECT doc_id, source FROM documents WHERE {_ACCEPT}",
    "stream_filter_stats": f"""SELECT doc_id, CAST({_ACCEPT} AS BIGINT) AS accepted, CAST({_EARLY} AND NOT {_ACCEPT} AS BIGINT) AS rejected_in_detail,
        CAST(NOT {_EARLY} AS BIGINT) AS rejected_early, len({_CHUNKS}) AS n_chunks, len({_VALID}) AS n_valid_chunks FROM documents""",
    "topic_counts": " UNION ALL ".join(f"SELECT doc_id, '{t}' AS topic, {_sum(k['core'])} AS core, {_sum(k['secondary'])} AS secondary FROM documents" for t, k in LEXICON.lexicon.items()),
    "topic_categories": f"SELECT doc_id, {_STRING} AS categories FROM (SELECT doc_id, {_CATEGORIES} AS c FROM documents)",
    "topic_single_keyword": f"""SELECT doc_id, array_to_string(list_filter([CASE WHEN {_n('and')} >= 7 OR {_n('the')} >= 7 THEN 'english' END,
        CASE WHEN {_n('der')} >= 7 THEN 'german' END], lambda c: c IS NOT NULL), ',') AS categories FROM documents""",
    "category_string_parse": f"SELECT doc_id, array_to_string({_CATEGORIES}, '|') AS parsed FROM documents",
    "docs_per_topic": " UNION ALL ".join(f"SELECT '{t}' AS category, count(*) FILTER ({_ACCEPT} AND {_MET[t]}) AS docs FROM documents" for t in NAMES),
    "refiltered": f"SELECT doc_id, {_STRING} AS categories FROM (SELECT doc_id, list_filter([{', '.join(map(_separated, NAMES))}], lambda c: c IS NOT NULL) AS c FROM documents) WHERE len(c) > 0",
    "url_tld": f"SELECT page_id, {_TLD} AS tld FROM pages",
    "docs_per_tld": f"SELECT {_TLD} AS tld, count(*) AS docs FROM pages GROUP BY 1",
    "distinct_records": "SELECT count(*) AS records, count(DISTINCT doc_id) AS distinct_records FROM (SELECT doc_id FROM labels UNION ALL SELECT doc_id FROM documents)",
    "doc_lengths": "SELECT doc_id, coalesce(length(text), 0) AS content_length FROM documents",
    "length_band": "SELECT doc_id, length(text) AS content_length FROM documents WHERE length(text) BETWEEN 500 AND 80000",
    "ledger_progress": f"""WITH {_LEDGER}, c AS (SELECT count(*) AS t, count(*) FILTER (finished) AS f, count(*) FILTER (started) AS s, count(*) FILTER (started AND NOT finished) AS e FROM led)
        SELECT t AS total, f AS finished, t - f AS remaining, e AS errored, round(100.0 * f / nullif(t, 0), 2) AS finished_pct,
               round(100.0 * (t - f) / nullif(t, 0), 2) AS remaining_pct, round(100.0 * e / nullif(s, 0), 2) AS errored_pct FROM c""",
    "ledger_incomplete": f"WITH {_LEDGER} SELECT wet_path FROM led WHERE started AND NOT finished",
    "subword_counts": r"""WITH t AS (SELECT lower(regexp_replace(unnest(string_split(text, ' ')), '[!-/:-@\[-`{-~]', '', 'g')) AS subword FROM documents)
        SELECT subword, count(*) AS n FROM t WHERE starts_with(subword, 'tion') OR ends_with(subword, 'tion') GROUP BY subword""",
    "shingle_stats": f"WITH {_SHINGLES} SELECT doc_id, len(shingles) AS n, md5(array_to_string(list_sort(shingles), '|')) AS digest FROM sh",
    "minhash_groups": f"WITH {_GROUPS} SELECT array_to_string(ids, ',') AS ids, round(similarity, 6) AS similarity FROM gr",
    "minhash_buckets": f"WITH {_hashes(5)}, b AS (SELECT doc_id, min(h) AS bucket FROM mh GROUP BY doc_id) SELECT bucket, count(*) AS n FROM b GROUP BY bucket HAVING count(*) > 1",
    "near_dup_discards": f"WITH {_GROUPS} SELECT DISTINCT doc_id FROM ranked WHERE rn > 1",
    "most_relevant_per_group": f"WITH {_GROUPS} SELECT array_to_string(ids, ',') AS ids, doc_id AS best FROM ranked WHERE rn = 1",
    "deduped_corpus": f"""WITH {_GROUPS} SELECT d.doc_id, d.source FROM documents d JOIN sh USING (doc_id)
        WHERE len(sh.shingles) > 0 AND d.doc_id NOT IN (SELECT doc_id FROM ranked WHERE rn > 1)""",
    "search_topk": f"WITH {_SEARCH} SELECT * FROM scored WHERE relevance > 0.1 ORDER BY relevance DESC, doc_id LIMIT 50",
    "search_ranking": f"WITH {_SEARCH} SELECT * FROM scored WHERE relevance > 0.1",
    "corpus_join": f"""WITH {_SEARCH}, k AS (SELECT * FROM scored WHERE relevance > 0.1 ORDER BY relevance DESC, doc_id LIMIT 50)
        SELECT doc_id, relevance, md5(text) AS text_md5 FROM k JOIN documents USING (doc_id)""",
    "quality_corpus": "SELECT doc_id, lang FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE quality = 1)",
    "random_paths": f"WITH {_LEDGER} SELECT wet_path FROM led WHERE NOT finished ORDER BY md5(CAST(wet_path AS VARCHAR)), wet_path LIMIT 10",
    "wet_parse": """SELECT doc_id, md5(trim(coalesce(text, ''), ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))) AS content_md5, strlen(coalesce(text, '')) AS content_bytes,
        'org' AS tld, 'documents.wet.gz' AS file_name, true AS complete FROM documents""",
    "substring_filter": "SELECT doc_id FROM documents WHERE contains(text, 'gun')",
    "bucket_duplicates": f"WITH {_BUCKETS} SELECT bucket, doc_id, best FROM r WHERE n > 1",
    "bucket_corpus": f"WITH {_BUCKETS} SELECT DISTINCT bucket, best FROM r",
    "shingle_nine": f"WITH {_NINE} SELECT doc_id, len(shingles) AS n, md5(array_to_string(list_sort(shingles), '|')) AS digest FROM sh",
    "feature_space": f"WITH {_SPACE} SELECT shingle, index FROM space",
    "feature_space_size": f"WITH {_SPACE} SELECT count(*) AS features FROM space",
    "feature_vectors": f"""WITH {_SPACE}, v AS (SELECT doc_id, list_sort(list(index)) AS i FROM (SELECT doc_id, unnest(shingles) AS shingle FROM sh) JOIN space USING (shingle) GROUP BY doc_id)
        SELECT doc_id, coalesce(array_to_string(i, ','), '') AS indices FROM documents LEFT JOIN v USING (doc_id)""",
    "topic_stats": f"SELECT doc_id, array_to_string({_CATEGORIES}, ',') AS categories FROM documents",
    "category_overlap": f"""SELECT doc_id, array_to_string(c, ',') AS common FROM (SELECT doc_id, list_filter({_CATEGORIES}, lambda x: x IN ('article', 'spanish')) AS c FROM documents) WHERE len(c) > 0""",
    "first_paths": f"WITH {_LEDGER} SELECT wet_path FROM led ORDER BY wet_path LIMIT 10",
    "line_hashes": "SELECT doc_id, array_to_string(list_transform(string_split(text, chr(10)), lambda l: ltrim(md5(l), '0')), ',') AS hashes FROM documents",
    "sentences": r"""WITH s AS (SELECT doc_id, list_filter(string_split(regexp_replace(text, '([.?!])[ \t\n\r\f]+', '\1' || chr(1), 'g'), chr(1)), lambda x: x <> '') AS s FROM documents)
        SELECT doc_id, len(s) AS n, md5(array_to_string(s, '|')) AS digest FROM s""",
}
