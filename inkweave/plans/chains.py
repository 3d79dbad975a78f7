"""Queries of chained operators: volumes split by page, page layout, two readings, rebuilt sentences, alignment, files."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from inkweave.functions import text as T
from inkweave.operators import consensus, layout, lexicon, pages, patching, sequences, stream, vectors
from inkweave.plans.queries import _FORMS, _VOCAB, _vocabulary
from inkweave.plans.registry import query
from inkweave.session import checkpoint_dir
from inkweave.sources import files
from inkweave.sources.tables import corpus_rows, spread, table

# ---------------------------------------------------------------- volumes: a source of documents stands for a volume, a document for a page

_DOC_PAGES = r"""
d AS (SELECT source, doc_id, coalesce(text, '') AS t FROM documents),
k AS (SELECT *, regexp_extract_all(lower(t), '[$VI]+') AS ts FROM d),
m AS (SELECT *, CAST(len(ts) AS INTEGER) AS tokens, round(CASE WHEN len(ts) > 0 THEN len(list_filter(ts, lambda x: regexp_matches(x, '[$MARKED]'))) / len(ts) ELSE 0.0 END, 3) AS ratio FROM k),
p AS (SELECT source, doc_id, t, tokens, ratio, CASE WHEN tokens < 10 THEN 'BLANK' WHEN ratio >= 0.65 THEN 'VI' ELSE 'HAN' END AS label FROM m),
i AS (SELECT *, sum(CASE WHEN label = 'VI' THEN 1 ELSE 0 END) OVER (PARTITION BY source ORDER BY doc_id) AS island FROM p),
r AS (SELECT source, island, count(*) FILTER (label = 'HAN') AS n, min(doc_id) FILTER (label = 'HAN') AS first FROM i GROUP BY ALL),
st AS (SELECT source, min(first) FILTER (n > 3) AS han_start FROM r GROUP BY source),
bo AS (SELECT st.source, han_start, CASE WHEN han_start IS NULL THEN (SELECT max(doc_id) + 1 FROM p WHERE p.source = st.source)
  ELSE coalesce((SELECT max(doc_id) + 1 FROM p WHERE p.source = st.source AND label = 'VI' AND doc_id < han_start), han_start) END AS boundary FROM st)"""


def _doc_pages(s: SparkSession, d: str) -> DataFrame:
    return spread(table(s, d, "documents")).select("source", "doc_id", F.coalesce("text", F.lit("")).alias("text"), F.lit(0.0).alias("ink"))


@query(f"WITH {_DOC_PAGES} SELECT source, han_start, boundary FROM bo")
def han_starts(s: SparkSession, d: str) -> DataFrame:
    labelled = pages.classified_pages(_doc_pages(s, d), "text", "ink").select("source", "doc_id", "label")
    return pages.han_starts(labelled, ["source"], "doc_id", "label")


_SIGNALS = rf"""
li AS (SELECT *, len(list_filter(regexp_split_to_array(trim(t), '[\s\p{{Z}}]+'), lambda x: x <> '')) AS nt, list_filter(regexp_split_to_array(t, '\r\n|\n|\r'), lambda x: NOT regexp_full_match(x, '[\s\p{{Z}}]*')) AS ls FROM $FROM),
fr AS (SELECT *, len(list_filter(ls, lambda x: regexp_matches(x, '{pages.INDEX_LINE}'))) / greatest(len(ls), 1) AS ix,
  len(list_filter(ls, lambda x: len(list_filter(regexp_split_to_array(trim(x), '[\s\p{{Z}}]+'), lambda y: y <> '')) <= 4)) / greatest(len(ls), 1) AS sh FROM li),
an AS (SELECT *, ix >= 0.5 OR regexp_matches(t, '(?i){pages.BACK_MATTER}') OR len(list_filter(ls, lambda x: regexp_matches(x, '(?i){pages.CONTENTS}')
  AND len(list_filter(regexp_split_to_array(trim(x), '[\s\p{{Z}}]+'), lambda y: y <> '')) <= 3)) > 0 AS is_anchor FROM fr),
sg AS (SELECT source, doc_id, CAST(nt AS INTEGER) AS n_tokens, regexp_matches(t, '{pages.LEAF}') AND (nt >= 120 OR regexp_matches(t, '(?i){pages.BODY_WORD}')) AS is_leaf,
  regexp_matches(t, '(?i){pages.HALF_TITLE}') AND nt < 120 AS is_half_title, is_anchor,
  regexp_matches(t, '{pages.LEAF}') OR (len(ls) >= 10 AND sh < 0.35 AND ix < 0.2 AND NOT is_anchor) AS is_body FROM an)"""


@query(f"WITH {_DOC_PAGES}, {_SIGNALS.replace('$FROM', 'p')} SELECT doc_id, n_tokens, is_leaf, is_half_title, is_anchor, is_body FROM sg")
def page_signals(s: SparkSession, d: str) -> DataFrame:
    return pages.page_signals(_doc_pages(s, d), "text").select("doc_id", "n_tokens", "is_leaf", "is_half_title", "is_anchor", "is_body")


_SPLIT = rf"""{_DOC_PAGES},
hf AS (SELECT p.*, CASE WHEN label = 'VI' AND doc_id < boundary THEN 'vi' WHEN label = 'HAN' AND doc_id >= boundary THEN 'han' END AS half FROM p JOIN bo USING (source)),
vp AS (SELECT * FROM hf WHERE half = 'vi'), {_SIGNALS.replace('$FROM', 'vp')},
bs AS (SELECT source, coalesce(min(doc_id) FILTER (is_leaf), (SELECT min(doc_id) FROM sg x WHERE x.source = sg.source AND n_tokens >= 120
  AND doc_id > (SELECT max(doc_id) FROM sg y WHERE y.source = sg.source AND is_half_title))) AS body_start FROM sg GROUP BY source),
kp AS (SELECT sg.* FROM sg JOIN bs USING (source) WHERE body_start IS NULL OR doc_id >= body_start),
be AS (SELECT source, CASE WHEN max(doc_id) FILTER (is_body) < max(doc_id) AND max(doc_id) FILTER (is_anchor) > max(doc_id) FILTER (is_body) THEN max(doc_id) FILTER (is_body) END AS body_end FROM kp GROUP BY source),
sp AS (SELECT hf.source, hf.doc_id, tokens, ratio, label, half, CASE WHEN half = 'han' THEN 'body'
  WHEN half = 'vi' THEN CASE WHEN doc_id < body_start THEN 'front' WHEN doc_id > body_end THEN 'back' ELSE 'body' END END AS part
  FROM hf LEFT JOIN bs USING (source) LEFT JOIN be USING (source))"""


@query(f"WITH {_SPLIT} SELECT source, doc_id, tokens, ratio AS diac_ratio, label, half, part FROM sp")
def split_volumes(s: SparkSession, d: str) -> DataFrame:
    return pages.split_volumes(_doc_pages(s, d), ["source"], "doc_id", "text", "ink")


@query(f"""WITH {_SPLIT} SELECT source, count(*) AS num_pages, count(*) FILTER (half = 'vi' AND part = 'body') AS vi_pages, count(*) FILTER (part = 'front') AS front,
  count(*) FILTER (part = 'back') AS back, count(*) FILTER (half = 'han') AS han_pages, count(*) FILTER (label = 'BLANK') AS blank,
  min(doc_id) FILTER (half = 'vi' AND part = 'body') AS vi_first, max(doc_id) FILTER (half = 'vi' AND part = 'body') AS vi_last, min(doc_id) FILTER (half = 'han') AS han_first
FROM sp GROUP BY source""")
def volume_manifest(s: SparkSession, d: str) -> DataFrame:
    return pages.volume_manifest(pages.split_volumes(_doc_pages(s, d), ["source"], "doc_id", "text", "ink"), ["source"], "doc_id")


# ---------------------------------------------------------------- page layout

# What only a running head says.
_HEADS = "政要卷之 命政要卷"
_COLUMNS = """
g AS (SELECT vol, page, id, bbox, coalesce(sinonom, '') AS t, conf, (bbox[1] + bbox[3]) / 2 AS cx, (bbox[2] + bbox[4]) / 2 AS cy, bbox[3] - bbox[1] AS bw,
  CAST(bbox[3] - bbox[1] AS BIGINT) * (bbox[4] - bbox[2]) AS area FROM b WHERE len(bbox) = 4 AND bbox[1] + bbox[3] IS NOT NULL),
pg AS (SELECT vol, page, coalesce(nullif(median(bw), 0), 1.0) AS w, coalesce(nullif(median(area), 0), 1.0) AS a, max(bbox[3]) AS pw FROM g GROUP BY ALL),
k AS (SELECT g.*, w, pw, row_number() OVER (PARTITION BY vol, page ORDER BY cx DESC, id) AS n FROM g JOIN pg USING (vol, page) WHERE area >= 0.06 * a),
r AS (SELECT vol, page, n, 0 AS c, cx AS total, 1 AS cnt FROM k WHERE n = 1
  UNION ALL SELECT k.vol, k.page, k.n, CASE WHEN abs(k.cx - total / cnt) <= 0.55 * w THEN c ELSE c + 1 END,
    CASE WHEN abs(k.cx - total / cnt) <= 0.55 * w THEN total + k.cx ELSE k.cx END, CASE WHEN abs(k.cx - total / cnt) <= 0.55 * w THEN cnt + 1 ELSE 1 END
  FROM r JOIN k ON k.vol = r.vol AND k.page = r.page AND k.n = r.n + 1),
e AS (SELECT k.*, c, max(c) OVER (PARTITION BY k.vol, k.page) AS last FROM k JOIN r ON k.vol = r.vol AND k.page = r.page AND k.n = r.n),
cl AS (SELECT vol, page, c, any_value(w) AS w, any_value(pw) AS pw, any_value(last) AS last, count(*) AS n, avg(cx) AS mx, avg(bw) AS mw, min(cx) AS lo, max(cx) AS hi,
  bool_or(bw < 0.62 * w) AS narrow, string_agg(t, '' ORDER BY n) AS read, round(min(conf), 3) AS conf, min(bbox[1]) AS x0, min(bbox[2]) AS y0, max(bbox[3]) AS x1, max(bbox[4]) AS y1 FROM e GROUP BY ALL),
kc AS (SELECT *, n >= 4 OR (n >= 3 AND narrow AND hi - lo > 0.28 * w) AS is_double FROM cl
  WHERE NOT (((c = 0 OR c = last) AND (mx < 0.16 * pw OR mx > pw - 0.16 * pw) AND mw < 0.72 * w) OR contains(read, '政要卷之') OR contains(read, '命政要卷'))),
o AS (SELECT kc.vol, kc.page, kc.c, string_agg(t, '' ORDER BY is_double AND cx < (hi + lo) / 2, cy, e.n) AS text FROM kc JOIN e ON kc.vol = e.vol AND kc.page = e.page AND kc.c = e.c GROUP BY ALL)"""


@query(f"""WITH RECURSIVE $ONCE, {_COLUMNS}
SELECT vol, page, CAST(row_number() OVER (PARTITION BY vol, page ORDER BY c) AS INTEGER) AS column_no, n, x0, y0, x1, y1, text, conf, is_double FROM kc JOIN o USING (vol, page, c)""")
def page_columns(s: SparkSession, d: str) -> DataFrame:
    boxes = corpus_rows(s, d, "han_boxes", "page", "bbox", "sinonom", "conf")
    return layout.columns_of_pages(boxes, ["vol", "page"], F.max(F.col("bbox")[2]), tuple(_HEADS.split()))


@query("""
WITH RECURSIVE $ONCE, k AS (SELECT vol, page, id, bbox[1] AS x, bbox[2] AS y, row_number() OVER (PARTITION BY vol, page ORDER BY bbox[2], bbox[1], id) AS n FROM b WHERE len(bbox) = 4),
r AS (SELECT vol, page, n, 1 AS row_no, y AS top FROM k WHERE n = 1
  UNION ALL SELECT k.vol, k.page, k.n, CASE WHEN k.y - top > 12 THEN row_no + 1 ELSE row_no END, CASE WHEN k.y - top > 12 THEN k.y ELSE top END
  FROM r JOIN k ON k.vol = r.vol AND k.page = r.page AND k.n = r.n + 1)
SELECT k.vol, k.page, k.id, row_no, CAST(row_number() OVER (PARTITION BY k.vol, k.page ORDER BY row_no, x, y, k.id) AS INTEGER) AS place FROM k JOIN r ON k.vol = r.vol AND k.page = r.page AND k.n = r.n""")
def reading_order(s: SparkSession, d: str) -> DataFrame:
    return layout.reading_order(corpus_rows(s, d, "han_boxes", "page", "bbox"), ["vol", "page"])


@query("""WITH $ONCE SELECT vol, id, CAST(greatest(bbox[1] + 4, 0) * 2 AS INTEGER) AS x0, CAST(greatest(bbox[2] + 4, 0) * 2 AS INTEGER) AS y0,
  CAST(least(bbox[3] - 4, 1600) * 2 AS INTEGER) AS x1, CAST(least(bbox[4] - 4, 2400) * 2 AS INTEGER) AS y1 FROM b WHERE len(bbox) = 4 AND bbox[4] - bbox[2] >= 8""")
def crop_windows(s: SparkSession, d: str) -> DataFrame:
    """What a second reader is shown of each line: inset by 4 pixels, twice as large."""
    boxes = layout.tall_enough(corpus_rows(s, d, "han_boxes", "bbox"))
    w = layout.crop_window(F.col("bbox"), F.lit(1600), F.lit(2400), pad=-4, scale=2)
    return boxes.select("vol", "id", *(w[k].alias(n) for k, n in enumerate(("x0", "y0", "x1", "y1"))))


# ---------------------------------------------------------------- two readings


def _second_readings(s: SparkSession, d: str) -> DataFrame:
    """Each column with, as its second reading, the sentences that say to cover it."""
    boxes = corpus_rows(s, d, "han_boxes", "page", "sinonom", "am_han_viet", where="sinonom is not null")
    rows = corpus_rows(s, d, "han_sentences", "chapter", "page", "sent_idx", "sinonom", "box_ids", where="box_ids is not null")
    each = rows.select("vol", F.explode("box_ids").alias("box"), F.struct("chapter", "page", "sent_idx", "id", "sinonom").alias("x"))
    told = each.groupBy("vol", F.col("box").alias("id")).agg(F.sort_array(F.collect_list("x")).alias("x"))
    return boxes.join(told.select("vol", "id", T.without_marks(F.array_join("x.sinonom", "")).alias("second")), ["vol", "id"], "left")


_FOLDS = " ".join(p[1] + p[0] for p in _FORMS.split())


@query()
def column_consensus(s: SparkSession, d: str) -> DataFrame:
    voted = consensus.consensus(_second_readings(s, d), "sinonom", "second", folds=_FOLDS)
    return voted.select("vol", "id", "reading", F.array_join(F.transform("review", lambda r: F.concat_ws(":", r["pos"].cast("string"), r["base"], r["other"])), " ").alias("review"))


_FORM_PAIRS = "".join(f"when '{p[0]}' then '{p[1]}' " for p in _FORMS.split())
_FORM_VOTE = f"""
x AS (SELECT vol, id, sinonom, translate(sinonom, '{"".join(p[0] for p in _FORMS.split())}', '{"".join(p[1] for p in _FORMS.split())}') AS second FROM b WHERE sinonom IS NOT NULL),
c AS (SELECT vol, id, sinonom, second, list_filter(range(0, length(sinonom)), lambda k: substr(sinonom, k + 1, 1) <> substr(second, k + 1, 1)) AS ps FROM x)"""


def _form_vote(s: SparkSession, d: str, mode: str) -> DataFrame:
    rows = corpus_rows(s, d, "han_boxes", "sinonom", where="sinonom is not null")
    return consensus.consensus(rows.withColumn("second", sequences.mapped_characters(F.col("sinonom"), _FORMS)[0]), "sinonom", "second", mode)


@query(f"""WITH $ONCE, {_FORM_VOTE} SELECT vol, id, second AS reading, array_to_string(list_transform(ps, lambda k: k || ':' || substr(sinonom, k + 1, 1) || ':' || substr(second, k + 1, 1)), ' ') AS review FROM c""")
def form_consensus(s: SparkSession, d: str) -> DataFrame:
    """The vote between a column as read and its traditional form: the second stands and every change is reviewed."""
    told = F.array_join(F.transform("review", lambda r: F.concat_ws(":", r["pos"].cast("string"), r["base"], r["other"])), " ")
    return _form_vote(s, d, "arbiter").select("vol", "id", "reading", told.alias("review"))


@query(f"""WITH $ONCE, {_FORM_VOTE} SELECT vol, count(*) AS cols, CAST(sum(length(sinonom)) AS BIGINT) AS chars, count(*) FILTER (len(ps) > 0) AS review_cols, CAST(sum(len(ps)) AS BIGINT) AS review_chars,
  count(*) FILTER (len(ps) > 0) AS corrected_cols, 100.0 - round(100.0 * sum(len(ps)) / greatest(sum(length(sinonom)), 1), 2) AS settled_percent FROM c GROUP BY vol""")
def consensus_figures(s: SparkSession, d: str) -> DataFrame:
    return consensus.consensus_figures(_form_vote(s, d, "arbiter"), ["vol"], "sinonom")


@query(f"""WITH $ONCE, {_FORM_VOTE}, lex AS (SELECT sinonom_char AS c, min(am_han_viet) AS r FROM hanviet WHERE sinonom_char IS NOT NULL AND am_han_viet IS NOT NULL GROUP BY 1),
ch AS (SELECT vol, id, unnest(cs) AS c, unnest(range(len(cs))) AS k FROM (SELECT vol, id, regexp_extract_all(second, '$CJK') AS cs FROM c WHERE len(ps) > 0)),
rd AS (SELECT vol, id, string_agg(coalesce(lex.r, '?'), ' ' ORDER BY k) AS r FROM ch LEFT JOIN lex USING (c) GROUP BY vol, id)
SELECT b.vol, b.id, coalesce(c.second, b.sinonom) AS sinonom, CASE WHEN len(c.ps) > 0 THEN coalesce(rd.r, '') ELSE b.am_han_viet END AS am_han_viet
FROM b LEFT JOIN c ON b.vol = c.vol AND b.id = c.id LEFT JOIN rd ON b.vol = rd.vol AND b.id = rd.id""")
def applied_consensus(s: SparkSession, d: str) -> DataFrame:
    """The vote laid over the boxes; the reading is looked up anew where the text changed."""
    rows = corpus_rows(s, d, "han_boxes", "sinonom", "am_han_viet")
    done = consensus.applied(rows, _form_vote(s, d, "arbiter").select("vol", "id", "reading"), ["vol", "id"])
    again = lexicon.transliterated(done.where("changed"), ["vol", "id"], "sinonom", table(s, d, "hanviet"), "sinonom_char", "am_han_viet")
    met = done.join(again, ["vol", "id"], "left")
    return met.select("vol", "id", "sinonom", F.when(F.col("changed"), F.col("readings")).otherwise(F.col("am_han_viet")).alias("am_han_viet"))


# ---------------------------------------------------------------- sentences rebuilt from boxes

_ENDING = "也矣焉哉乎"


@query(f"""
WITH $ONCE, k AS (SELECT vol, chapter, page, id, coalesce(is_dbl, false) AS dbl, coalesce(sinonom, '') AS t, row_number() OVER (PARTITION BY vol, chapter ORDER BY page, box_idx, id) AS row_no FROM b),
ch AS (SELECT vol, chapter, page, id, row_no, unnest(string_split(t, '')) AS c, unnest(range(length(t))) AS j FROM k WHERE NOT dbl AND t <> ''),
n AS (SELECT *, row_number() OVER w AS pos, coalesce(sum(CASE WHEN contains('{_ENDING}', c) THEN 1 ELSE 0 END) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS seg
  FROM ch WINDOW w AS (PARTITION BY vol, chapter ORDER BY row_no, j)),
i AS (SELECT vol, chapter, seg, string_agg(id, ',' ORDER BY f) AS ids FROM (SELECT vol, chapter, seg, id, min(pos) AS f FROM n GROUP BY ALL) GROUP BY ALL),
g AS (SELECT vol, chapter, seg, string_agg(c, '' ORDER BY pos) AS segment, min(row_no) AS row_no, min(pos) AS pos, arg_min(page, pos) AS page FROM n GROUP BY ALL),
u AS (SELECT vol, chapter, page, row_no, pos, segment, ids, false AS is_dbl FROM g JOIN i USING (vol, chapter, seg)
  UNION ALL SELECT vol, chapter, page, row_no, -1, t, id, true FROM k WHERE dbl AND t <> ''),
z AS (SELECT *, CAST(row_number() OVER (PARTITION BY vol, chapter, page ORDER BY row_no, pos) AS INTEGER) AS sent_idx FROM u)
SELECT vol, printf('HVH_001.%03d.%03d.%02d', chapter, page, sent_idx) AS id, segment AS sinonom, ids AS box_ids, is_dbl FROM z""")
def rebuilt_sentences(s: SparkSession, d: str) -> DataFrame:
    """Sentences of the box stream, cut at marks that are set behind final particles, with their ids."""
    boxes = corpus_rows(s, d, "han_boxes", "chapter", "page", "box_idx", "sinonom", "is_dbl")
    placed = boxes.withColumn("row_no", F.lit(0))
    key, order = ["vol", "chapter"], ["page", "box_idx", "id"]
    chars = stream.stream_characters(placed.where("NOT coalesce(is_dbl, false)"), key, order, "sinonom")
    marks = chars.where(F.lit(_ENDING).contains(F.col("c"))).select(*key, "pos", F.lit("。").alias("mark"))
    made = stream.rebuilt_sentences(boxes, marks, key, order, "sinonom", T.FINAL_MARKS)
    return made.select("vol", T.make_id(F.col("chapter"), F.col("page"), F.col("sent_idx")).alias("id"), F.col("segment").alias("sinonom"), F.array_join("box_ids", ",").alias("box_ids"), "is_dbl")


@query(f"""
WITH $ONCE, x AS (SELECT vol, page, id, sinonom AS t, coalesce(is_dbl, false) AS dbl, row_number() OVER (PARTITION BY vol, page ORDER BY sent_idx, id) AS row_no FROM h),
m AS (SELECT vol, page, coalesce(sum(length(t) - length(regexp_replace(t, '[{T.FINAL_MARKS}]', '', 'g'))) / nullif(sum(len(regexp_extract_all(t, '$CJK'))), 0) >= 0.01, false) AS cut FROM x GROUP BY ALL),
ch AS (SELECT vol, page, id, dbl, row_no, unnest(string_split(t, '')) AS c, unnest(range(length(t))) AS j FROM x JOIN m USING (vol, page) WHERE cut AND t <> ''),
n AS (SELECT *, row_number() OVER w AS pos, coalesce(sum(CASE WHEN contains('{T.FINAL_MARKS}', c) THEN 1 ELSE 0 END) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS seg
  FROM ch WINDOW w AS (PARTITION BY vol, page ORDER BY row_no, j)),
i AS (SELECT vol, page, seg, string_agg(id, ',' ORDER BY f) AS ids FROM (SELECT vol, page, seg, id, min(pos) AS f FROM n GROUP BY ALL) GROUP BY ALL),
g AS (SELECT vol, page, seg, string_agg(c, '' ORDER BY pos) AS segment, bool_or(dbl) AS is_dbl FROM n GROUP BY ALL),
u AS (SELECT vol, page, seg AS k, segment, ids, is_dbl FROM g JOIN i USING (vol, page, seg) UNION ALL SELECT vol, page, row_no, t, id, dbl FROM x JOIN m USING (vol, page) WHERE NOT cut)
SELECT vol, page, CAST(row_number() OVER (PARTITION BY vol, page ORDER BY k) AS INTEGER) AS sent_no, segment, ids AS box_ids, is_dbl FROM u""")
def page_sentences(s: SparkSession, d: str) -> DataFrame:
    """The sentences of every page: cut at its marks, or its rows where it has none."""
    rows = corpus_rows(s, d, "han_sentences", "page", "sent_idx", "sinonom", "is_dbl")
    made = stream.page_sentences(rows, ["vol", "page"], ["sent_idx", "id"], "sinonom", T.MARKS, T.FINAL_MARKS)
    return made.withColumn("box_ids", F.array_join("box_ids", ","))


_BLOCK = r"trim(regexp_replace(regexp_replace(regexp_replace(text, '-\s*\n\s*', '', 'g'), '\s*\n\s*', ' ', 'g'), '[ \t]{2,}', ' ', 'g'), ' ')"


@query(rf"""
WITH RECURSIVE $ONCE, n AS (SELECT vol, id, {_BLOCK} AS t FROM v WHERE text IS NOT NULL),
s AS (SELECT vol, id, t, list_filter(list_transform(string_split(regexp_replace(t, '{T.SENTENCE_END}', E'\\1\x01\\2', 'g'), E'\x01'), lambda x: trim(x, ' ')), lambda x: x <> '') AS ss FROM n),
r AS (SELECT vol, id, t, ss, 0 AS k, 0 AS start, 0 AS stop FROM s
  UNION ALL SELECT vol, id, t, ss, k + 1, stop + greatest(strpos(substr(t, stop + 1), ss[k + 1]) - 1, 0), stop + greatest(strpos(substr(t, stop + 1), ss[k + 1]) - 1, 0) + length(ss[k + 1]) FROM r WHERE k < len(ss))
SELECT vol, id, CAST(k AS INTEGER) AS sent_no, ss[k] AS sentence, CAST(start AS INTEGER) AS start_at, CAST(stop AS INTEGER) AS end_at FROM r WHERE k > 0""")
def located_sentences(s: SparkSession, d: str) -> DataFrame:
    rows = corpus_rows(s, d, "vi_sentences", "text", where="text is not null")
    spans = rows.select("vol", "id", F.posexplode(T.sentence_spans(T.normal_block(F.col("text")))).alias("k", "x"))
    return spans.select("vol", "id", (F.col("k") + 1).alias("sent_no"), "x.sentence", "x.start_at", "x.end_at")


# ---------------------------------------------------------------- sequences



@query("""
WITH $ONCE, k AS (SELECT vol, id, regexp_extract_all(lower(coalesce(text, '')), '[$VI]+') AS a, regexp_extract_all(lower(coalesce(raw_text, '')), '[$VI]+') AS b FROM v),
u AS (SELECT *, list_distinct(list_concat(a, b)) AS voc FROM k),
c AS (SELECT vol, id, len(a) AS n, len(b) AS m, coalesce(array_to_string(list_transform(a, lambda t: chr(CAST(list_position(voc, t) AS INTEGER))), ''), '') AS x,
  coalesce(array_to_string(list_transform(b, lambda t: chr(CAST(list_position(voc, t) AS INTEGER))), ''), '') AS y FROM u)
SELECT vol, id, round(1 - levenshtein(x, y) / greatest(n, m, 1), 4) AS similarity FROM c""")
def token_similarity(s: SparkSession, d: str) -> DataFrame:
    rows = corpus_rows(s, d, "vi_sentences", "text", "raw_text")
    return rows.select("vol", "id", F.round(sequences.token_similarity(T.vi_tokens(F.col("text")), T.vi_tokens(F.col("raw_text"))), 4).alias("similarity"))


@query()
def text_provenance(s: SparkSession, d: str) -> DataFrame:
    rows = sequences.with_provenance(corpus_rows(s, d, "vi_sentences", "text", where="text is not null", costly=True), "text")
    return rows.select("vol", "id", "clean", F.array_join(F.transform("places", lambda p: p.cast("string")), " ").alias("places"))


@query("WITH $ONCE SELECT vol, id, regexp_replace(nfc_normalize(strip_accents(text)), '\\p{Mn}', '', 'g') AS plain FROM v WHERE text IS NOT NULL")
def plain_letters(s: SparkSession, d: str) -> DataFrame:
    return corpus_rows(s, d, "vi_sentences", "text", where="text is not null").select("vol", "id", T.strip_accents(F.col("text")).alias("plain"))


@query("""WITH $ONCE SELECT vol, id, regexp_replace(replace(replace(replace(regexp_replace('<b>' || text || '</b>【' || id || '】', '</?[^>]+>', '', 'g'), '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '【(.*?)】', '<mark>\\1</mark>', 'g') AS shown,
  string_split(id, '.')[1] || '_' || n_tokens AS name FROM v WHERE text IS NOT NULL AND n_tokens IS NOT NULL""")
def shown_context(s: SparkSession, d: str) -> DataFrame:
    """A row as a page shows it: tags taken out, signs escaped, the id marked."""
    rows = corpus_rows(s, d, "vi_sentences", "text", "n_tokens", where="text is not null and n_tokens is not null")
    tagged = F.concat(F.lit("<b>"), F.col("text"), F.lit("</b>【"), F.col("id"), F.lit("】"))
    return rows.select("vol", "id", T.marked_context(T.without_tags(tagged)).alias("shown"), T.derived_volume(F.col("id"), F.col("n_tokens")).alias("name"))


@query("""WITH $ONCE SELECT vol, id, array_to_string(regexp_extract_all(sinonom, '[\\x{3400}-\\x{9FFF}\\x{F900}-\\x{FAFF}]'), '') AS han FROM b WHERE sinonom IS NOT NULL""")
def han_only(s: SparkSession, d: str) -> DataFrame:
    return corpus_rows(s, d, "han_boxes", "sinonom", where="sinonom is not null").select("vol", "id", T.han_only(F.col("sinonom")).alias("han"))


#: Phrases and what stands for them, in this order.
PHRASES = [("thuỵ khang", "Thụy Khang"), ("tháng riêng", "tháng giêng"), ("bấy giờ", "lúc ấy")]


def _phrase_sql() -> str:
    text, side = "text", "[^0-9A-Za-zÀ-ỹĐđ]"
    for wrong, right in PHRASES:
        words = [w for w in wrong.split()]
        low = "[\\s\\-]+".join(f"(?i:{w})" for w in words)
        first = "[\\s\\-]+".join([f"{words[0][0].upper()}(?i:{words[0][1:]})", *(f"(?i:{w})" for w in words[1:])])
        caps = "[\\s\\-]+".join(w.upper() for w in words)
        for pattern, to in ((caps, right.upper()), (first, right[0].upper() + right[1:]), (low, right)):
            text = f"regexp_replace({text}, '(^|{side}){pattern}({side}|$)', '\\1{to}\\2', 'g')"
    return text


@query(f"WITH $ONCE SELECT vol, id, {_phrase_sql()} AS corrected FROM v WHERE text IS NOT NULL")
def corrected_phrases(s: SparkSession, d: str) -> DataFrame:
    rows = corpus_rows(s, d, "vi_sentences", "text", where="text is not null")
    return patching.phrases_corrected(rows, "text", PHRASES).select("vol", "id", F.col("text").alias("corrected"))


@query(f"""
WITH $ONCE, {_VOCAB}, t AS (SELECT vol, id, list_distinct(regexp_extract_all(lower(text), '[$VI]+')) AS d, regexp_extract_all(lower(text), '[$VI]+') AS ts FROM v),
e AS (SELECT vol, id, unnest(d) AS token, ts FROM t), o AS (SELECT vol, id, token, list_position(ts, token) AS k FROM e WHERE token NOT IN (SELECT token FROM voc))
SELECT vol, id, string_agg(token, ' ' ORDER BY k) AS unknown FROM o GROUP BY vol, id""")
def unknown_tokens(s: SparkSession, d: str) -> DataFrame:
    made = lexicon.unknown_tokens(corpus_rows(s, d, "vi_sentences", "text"), ["vol", "id"], T.vi_tokens(F.col("text")), _vocabulary(s, d))
    return made.select("vol", "id", F.array_join("unknown", " ").alias("unknown"))


# ---------------------------------------------------------------- alignment of sentence vectors


def bag_vector(tokens: Column, size: int = 32) -> Column:
    """A vector of token counts by hash, a stand-in for a model's vector."""
    spots = F.transform(tokens, lambda t: F.pmod(F.xxhash64(t), F.lit(size)))
    return T.let(spots, lambda xs: F.transform(F.sequence(F.lit(0), F.lit(size - 1)), lambda k: F.size(F.filter(xs, lambda x: x == k)).cast("double")))


def _sides(s: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Both sides of every chapter with order, text, tokens and token weights; interlinear and unknown rows take no part."""
    han = corpus_rows(s, d, "han_sentences", "chapter", "page", "sent_idx", "sinonom", "am_han_viet", where="NOT coalesce(is_dbl, false)", costly=True)
    vi = corpus_rows(s, d, "vi_sentences", "chapter", "page", "sent_idx", "text", where="text is not null", costly=True)
    vi = vi.join(lexicon.known_rows(vi, ["vol", "id"], T.vi_tokens(F.col("text")), _vocabulary(s, d)).select("vol", "id"), ["vol", "id"], "left_semi")
    order = F.col("page") * 100_000 + F.col("sent_idx")
    counted = T.let(F.col("tokens"), lambda ts: F.map_from_arrays(F.array_distinct(ts), F.transform(F.array_distinct(ts), lambda t: F.size(F.filter(ts, lambda x: x == t)).cast("double"))))
    said = F.coalesce("am_han_viet", F.lit(""))
    left = han.select("vol", "chapter", order.alias("ord"), "id", F.col("sinonom").alias("text"), said.alias("reading"), T.vi_tokens(said).alias("tokens"))
    right = vi.select("vol", "chapter", order.alias("ord"), "id", "text", T.vi_tokens(F.col("text")).alias("tokens"))
    return left.withColumn("weights", counted), right.withColumn("weights", counted)


@query()
def chapter_pairs(s: SparkSession, d: str) -> DataFrame:
    """The rows of every chapter aligned m:n by vectors, with texts, scores and both flags."""
    left, right = _sides(s, d)
    key, keep = ["vol", "chapter"], ["vol", "chapter", "ord"]
    rows = left.select(*keep, F.lit("l").alias("side"), bag_vector(F.col("tokens")).alias("vector")).unionByName(right.select(*keep, F.lit("r").alias("side"), bag_vector(F.col("tokens")).alias("vector")))
    pairs = vectors.aligned_vectors(rows, key, "side", "ord", "vector")
    told = vectors.pair_texts(pairs, left, right, key, "ord")
    return vectors.suspects_flagged(told, ["vol"], "similarity", "lexical", "sparse", "right_text")


@query()
def vector_alignment(s: SparkSession, d: str) -> DataFrame:
    """Vectors with even ids against those with odd ids, in runs of 512 ids."""
    rows = table(s, d, "embeddings").withColumns({"side": F.when(F.col("vec_id") % 2 == 0, "l").otherwise("r"), "run": F.floor(F.col("vec_id") / 512)})
    return vectors.aligned_vectors(rows, ["label", "run"], "side", "vec_id", "embedding")


@query("""
WITH t AS (SELECT vol, coalesce(round(quantile_cont(bge_sparse, 0.1) FILTER (bge_sparse > 0 AND coalesce(vietnamese, '') <> ''), 3), 0.0) AS p10 FROM alignment GROUP BY vol)
SELECT vol, count(*) AS pairs, count(*) FILTER (similarity < 0.45 AND lexical < 0.05) AS suspects, count(*) FILTER (similarity < 0.45 AND bge_sparse < p10) AS suspects_sparse FROM alignment JOIN t USING (vol) GROUP BY vol""")
def suspect_counts(s: SparkSession, d: str) -> DataFrame:
    rows = table(s, d, "alignment").drop("suspect", "suspect_bge")
    return vectors.suspect_counts(vectors.suspects_flagged(rows, ["vol"], "similarity", "lexical", "bge_sparse", "vietnamese"), ["vol"])


@query("""
WITH $ONCE, p AS (SELECT a.vol, pair_idx, unnest(han_ids) AS id, unnest(range(len(han_ids))) AS k FROM alignment a), q AS (SELECT a.vol, pair_idx, unnest(vie_ids) AS id, unnest(range(len(vie_ids))) AS k FROM alignment a),
l AS (SELECT p.vol, pair_idx, string_agg(sinonom, '' ORDER BY k) AS sn, string_agg(coalesce(am_han_viet, ''), ' ' ORDER BY k) AS am FROM p JOIN h USING (vol, id) GROUP BY ALL),
r AS (SELECT q.vol, pair_idx, string_agg(coalesce(text, ''), ' ' ORDER BY k) AS vt FROM q JOIN v USING (vol, id) GROUP BY ALL)
SELECT a.vol, a.pair_idx, coalesce(sn, '') AS left_text, coalesce(am, '') AS left_reading, coalesce(vt, '') AS right_text FROM alignment a LEFT JOIN l USING (vol, pair_idx) LEFT JOIN r USING (vol, pair_idx)""")
def pair_texts(s: SparkSession, d: str) -> DataFrame:
    """The texts of an earlier run's pairs, joined anew from the rows they name."""
    pairs = table(s, d, "alignment").select("vol", F.col("pair_idx").alias("pair_no"), F.col("han_ids").alias("left"), F.col("vie_ids").alias("right"), "similarity")
    none = F.lit(None).cast("map<string,double>").alias("weights")
    han = corpus_rows(s, d, "han_sentences", "sinonom", "am_han_viet")
    vi = corpus_rows(s, d, "vi_sentences", "text")
    left = han.select("vol", F.col("id").alias("ord"), "id", F.col("sinonom").alias("text"), F.coalesce("am_han_viet", F.lit("")).alias("reading"), none)
    right = vi.select("vol", F.col("id").alias("ord"), "id", F.coalesce("text", F.lit("")).alias("text"), none)
    made = vectors.pair_texts(pairs, left, right, ["vol"], "ord")
    return made.select("vol", F.col("pair_no").alias("pair_idx"), "left_text", "left_reading", "right_text")


@query("""SELECT vol, pair_idx, array_to_string(han_ids, ', ') AS "Hán IDs", array_to_string(vie_ids, ', ') AS "Việt IDs", sinonom AS "SinoNom", am_han_viet AS "Âm Hán Việt", vietnamese AS "Nghĩa thuần Việt",
  similarity AS "Dense (bge)", lexical AS "Lexical (Jaccard)", bge_sparse AS "Sparse (bge)", CASE WHEN suspect THEN 'x' ELSE '' END AS "Nghi lệch (Jaccard)", CASE WHEN suspect_bge THEN 'x' ELSE '' END AS "Nghi lệch (bge)" FROM alignment""")
def alignment_workbook(s: SparkSession, d: str) -> DataFrame:
    """The ten columns of the alignment sheet."""
    flag = lambda c: F.when(F.coalesce(c, F.lit(False)), "x").otherwise("")
    return table(s, d, "alignment").select(
        "vol", "pair_idx", F.array_join("han_ids", ", ").alias("Hán IDs"), F.array_join("vie_ids", ", ").alias("Việt IDs"), F.col("sinonom").alias("SinoNom"), F.col("am_han_viet").alias("Âm Hán Việt"),
        F.col("vietnamese").alias("Nghĩa thuần Việt"), F.col("similarity").alias("Dense (bge)"), F.col("lexical").alias("Lexical (Jaccard)"), F.col("bge_sparse").alias("Sparse (bge)"),
        flag("suspect").alias("Nghi lệch (Jaccard)"), flag("suspect_bge").alias("Nghi lệch (bge)"),
    )


@query("""
WITH $ONCE, p AS (SELECT vol, pair_idx, vietnamese, unnest(han_ids) AS id FROM alignment WHERE vietnamese IS NOT NULL), m AS (SELECT vol, id, arg_max(vietnamese, pair_idx) AS meaning FROM p GROUP BY ALL)
SELECT b.vol, b.id AS "ID", '[' || array_to_string(bbox, ', ') || ']' AS "Image box", sinonom AS "SinoNom char", am_han_viet AS "Âm Hán Việt", coalesce(meaning, '') AS "Nghĩa thuần Việt" FROM b LEFT JOIN m ON b.vol = m.vol AND b.id = m.id""")
def box_workbook(s: SparkSession, d: str) -> DataFrame:
    """The box sheet: a box has the meaning of the sentence of the same id."""
    pairs = table(s, d, "alignment").where("vietnamese is not null").select("vol", "pair_idx", "vietnamese", F.explode("han_ids").alias("id"))
    last = pairs.groupBy("vol", "id").agg(F.max_by("vietnamese", "pair_idx").alias("meaning"))
    boxes = corpus_rows(s, d, "han_boxes", "bbox", "sinonom", "am_han_viet").join(last, ["vol", "id"], "left")
    shown = F.concat(F.lit("["), F.array_join(F.transform("bbox", lambda x: x.cast("string")), ", "), F.lit("]"))
    return boxes.select("vol", F.col("id").alias("ID"), shown.alias("Image box"), F.col("sinonom").alias("SinoNom char"), F.col("am_han_viet").alias("Âm Hán Việt"), F.coalesce("meaning", F.lit("")).alias("Nghĩa thuần Việt"))


# ---------------------------------------------------------------- review

_EDITS = """
e AS (SELECT vol, id, raw_text AS correct, n_tokens >= 20 AS reviewed, CASE WHEN text = '' THEN 'drop' ELSE 'edit' END AS fix_type FROM v WHERE raw_text IS NOT NULL AND (text <> raw_text OR text = '')),
f AS (SELECT DISTINCT vol, id FROM v WHERE n_tokens >= 4 AND oov_rate >= 0.2)"""


def _edited(s: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    rows = corpus_rows(s, d, "vi_sentences", "text", "raw_text", "n_tokens", "oov_rate")
    edits = rows.where("raw_text is not null and (text <> raw_text or text = '')").select(
        "vol", "id", F.col("raw_text").alias("correct"), (F.col("n_tokens") >= 20).alias("reviewed"), F.when(F.col("text") == "", "drop").otherwise("edit").alias("fix_type")
    )
    return rows.select("vol", "id", "text"), edits, rows.where("n_tokens >= 4 AND oov_rate >= 0.2").select("vol", "id")


@query(f"""WITH $ONCE, {_EDITS},
x AS (SELECT v.vol, v.id, v.text, e.vol IS NOT NULL AS has, correct, coalesce(reviewed, false) AS rv, coalesce(fix_type = 'drop', false) AS dr, f.vol IS NOT NULL AS fl FROM v LEFT JOIN e USING (vol, id) LEFT JOIN f USING (vol, id))
SELECT 'all' AS view, vol, id FROM x UNION ALL SELECT 'flagged', vol, id FROM x WHERE fl UNION ALL SELECT 'unreviewed', vol, id FROM x WHERE NOT rv AND NOT dr
UNION ALL SELECT 'edited', vol, id FROM x WHERE correct IS NOT NULL AND correct IS DISTINCT FROM text UNION ALL SELECT 'dropped', vol, id FROM x WHERE dr""")
def review_views(s: SparkSession, d: str) -> DataFrame:
    parts = _edited(s, d)
    made = [patching.view(*parts, ["vol", "id"], "text", name).select(F.lit(name).alias("view"), "vol", "id") for name in patching.VIEWS]
    out = made[0]
    for m in made[1:]:
        out = out.unionByName(m)
    return out


@query(f"""WITH $ONCE, {_EDITS} SELECT v.vol, count(*) AS total, count(*) FILTER (coalesce(reviewed, false) OR fix_type = 'drop') AS done, count(*) FILTER (correct IS NOT NULL AND correct IS DISTINCT FROM text) AS edited,
  count(*) FILTER (f.vol IS NOT NULL) AS flagged FROM v LEFT JOIN e USING (vol, id) LEFT JOIN f USING (vol, id) GROUP BY v.vol""")
def review_progress(s: SparkSession, d: str) -> DataFrame:
    return patching.review_progress(*_edited(s, d), ["vol", "id"], "text", ["vol"])


@query("""
WITH $ONCE, p AS (SELECT vol, id, unnest(box_ids) AS box, unnest(range(len(box_ids))) AS k FROM h)
SELECT p.vol, p.id, string_agg(b.id || ':' || CASE WHEN b.conf < 0.8 THEN 'char' ELSE 'box' END, ' ' ORDER BY k, b.id) AS remarks FROM p JOIN b ON p.vol = b.vol AND p.box = b.id WHERE b.conf < 0.9 GROUP BY ALL""")
def sentence_remarks(s: SparkSession, d: str) -> DataFrame:
    """The review entries of the boxes of each sentence."""
    review = corpus_rows(s, d, "han_boxes", "conf", where="conf < 0.9").select("vol", "id", F.when(F.col("conf") < 0.8, "char").otherwise("box").alias("level"))
    made = patching.gathered_flags(corpus_rows(s, d, "han_sentences", "box_ids"), ["vol", "id"], "box_ids", review, ["vol"])
    return made.select("vol", "id", F.array_join(F.transform("remarks", lambda r: F.concat_ws(":", r["id"], r["level"])), " ").alias("remarks"))


@query("""
WITH $ONCE, q AS (SELECT 'han' AS side, vol, id, conf AS score FROM b WHERE conf < 0.5 UNION ALL SELECT 'vi', vol, id, 1.0 FROM v WHERE n_tokens >= 4 AND oov_rate >= 0.2)
SELECT CAST(row_number() OVER (ORDER BY score, side, vol, id) AS INTEGER) AS rank, side, vol, id, score FROM q ORDER BY score, side, vol, id LIMIT 200""")
def review_first(s: SparkSession, d: str) -> DataFrame:
    """The 200 most doubtful rows of the review queue; rows without a score come last."""
    han = corpus_rows(s, d, "han_boxes", "conf", where="conf < 0.5").select(F.lit("han").alias("side"), "vol", "id", F.col("conf").alias("score"))
    vi = corpus_rows(s, d, "vi_sentences", where="n_tokens >= 4 AND oov_rate >= 0.2").select(F.lit("vi").alias("side"), "vol", "id", F.lit(1.0).alias("score"))
    top = han.unionByName(vi).orderBy("score", "side", "vol", "id").limit(200)
    return top.select(F.row_number().over(W.orderBy("score", "side", "vol", "id")).alias("rank"), "side", "vol", "id", "score")


@query("WITH $ONCE SELECT vol, id, array_to_string(list_sort(list_distinct(list_concat(coalesce(box_ids, []), [id]))), ',') AS ids FROM h")
def widened_box_ids(s: SparkSession, d: str) -> DataFrame:
    return corpus_rows(s, d, "han_sentences", "box_ids").select("vol", "id", F.array_join(patching.with_id_added(F.col("box_ids"), F.col("id")), ",").alias("ids"))


@query("WITH $ONCE SELECT vol, id, replace(sinonom, '政', '正') AS sinonom FROM h WHERE length(sinonom) - length(replace(sinonom, '政', '')) = 1 OR NOT contains(sinonom, '政')")
def edited_once(s: SparkSession, d: str) -> DataFrame:
    """Edits that must find what they replace exactly once."""
    rows = corpus_rows(s, d, "han_sentences", "sinonom", where="length(sinonom) - length(replace(sinonom, '政', '')) <= 1")
    edits = rows.where(F.col("sinonom").contains("政")).select("vol", "id", F.lit("政").alias("old"), F.lit("正").alias("new"))
    return patching.replaced_once(rows, edits, ["vol", "id"], "sinonom")


# ---------------------------------------------------------------- lexicons

_TAUGHT = """
ty AS (SELECT v AS char, list(DISTINCT key ORDER BY key) AS readings FROM (SELECT key, unnest(values) AS v FROM s2_readings WHERE key IS NOT NULL) GROUP BY v)"""


@query(f"""
WITH rd AS (SELECT sinonom_char AS char, min(am_han_viet) AS r FROM hanviet WHERE am_han_viet IS NOT NULL AND am_han_viet <> '' AND sinonom_char IS NOT NULL GROUP BY 1), {_TAUGHT},
every AS (SELECT char, 0 AS rank, 'readings' AS source, [r] AS rs FROM rd WHERE regexp_full_match(char, '$CJK') UNION ALL SELECT char, 3, 'taught', readings FROM ty WHERE regexp_full_match(char, '$CJK')),
f AS (SELECT char, min(rank) AS rank FROM every GROUP BY char), e AS (SELECT char, rank, unnest(rs) AS r, unnest(range(len(rs))) AS k FROM every),
o AS (SELECT char, r, min(rank * 1000 + k) AS n FROM e GROUP BY ALL)
SELECT f.char, (SELECT arg_min(r, n) FROM o WHERE o.char = f.char) AS reading, (SELECT string_agg(r, ' ' ORDER BY n) FROM o WHERE o.char = f.char) AS all_readings,
  CASE f.rank WHEN 0 THEN 'readings' ELSE 'taught' END AS source FROM f""")
def built_readings(s: SparkSession, d: str) -> DataFrame:
    """The reading table built anew from a reading source and the inverted word table."""
    made = _built(s, d)
    return made.select("char", "reading", F.array_join("all_readings", " ").alias("all_readings"), "source")


def _built(s: SparkSession, d: str) -> DataFrame:
    said = table(s, d, "hanviet").where("am_han_viet <> '' and sinonom_char is not null").groupBy(F.col("sinonom_char").alias("char")).agg(F.min("am_han_viet").alias("r"))
    readings = said.select("char", F.array("r").alias("readings"))
    none = s.createDataFrame([], "char string, readings array<string>")
    taught = lexicon.inverted(table(s, d, "s2_readings"), "key", "values", "char", "readings")
    return lexicon.built_readings(readings, none, s.createDataFrame([], "char string, reading string"), taught, s.createDataFrame([], "char string, variants array<string>"))


@query(f"""
WITH rd AS (SELECT sinonom_char AS char, min(am_han_viet) AS r FROM hanviet WHERE am_han_viet IS NOT NULL AND am_han_viet <> '' AND sinonom_char IS NOT NULL GROUP BY 1), {_TAUGHT},
e AS (SELECT r AS key, char AS v FROM rd UNION SELECT unnest(readings), char FROM ty WHERE regexp_full_match(char, '$CJK') UNION SELECT key, unnest(values) FROM s2_readings)
SELECT key, string_agg(v, ' ' ORDER BY v) AS values FROM (SELECT DISTINCT key, v FROM e WHERE v IS NOT NULL) GROUP BY key""")
def built_words(s: SparkSession, d: str) -> DataFrame:
    made = lexicon.built_words(_built(s, d), table(s, d, "s2_readings"))
    return made.select("key", F.array_join("values", " ").alias("values"))


# ---------------------------------------------------------------- files: written to a folder of the query's own and read back


def _folder(s: SparkSession) -> str:
    return f"{checkpoint_dir(s)}/files-{uuid.uuid4()}"


@query("WITH $ONCE SELECT vol, id, chapter, page, sent_idx, sinonom, am_han_viet, array_to_string(box_ids, ',') AS box_ids, is_dbl FROM h")
def records_back(s: SparkSession, d: str) -> DataFrame:
    """han_sentences as JSON lines by volume, and back."""
    path = _folder(s)
    files.write_records(corpus_rows(s, d, "han_sentences", "chapter", "page", "sent_idx", "sinonom", "am_han_viet", "box_ids", "is_dbl"), path)
    return files.records(s, path, "han_sentences").withColumn("box_ids", F.array_join("box_ids", ","))


@query("SELECT key, array_to_string(list_filter(values, lambda x: x <> ''), ' ') AS values FROM s2_readings")
def dictionary_back(s: SparkSession, d: str) -> DataFrame:
    path = _folder(s)
    files.write_dictionary(table(s, d, "s2_readings"), path)
    return files.dictionary(s, path).withColumn("values", F.array_join("values", " "))


@query("SELECT sinonom_char, am_han_viet, all_readings FROM hanviet")
def readings_back(s: SparkSession, d: str) -> DataFrame:
    path = _folder(s)
    files.write_readings(table(s, d, "hanviet"), path)
    return files.reading_table(s, path)


@query("SELECT 'alignment' AS name, count(*) AS pairs, count(DISTINCT vol) AS vols FROM alignment")
def report_back(s: SparkSession, d: str) -> DataFrame:
    """A one-row report as a JSON document, and back."""
    path = _folder(s)
    files.write_document(table(s, d, "alignment").agg(F.lit("alignment").alias("name"), F.count("*").alias("pairs"), F.count_distinct("vol").alias("vols")), path)
    return files.document(s, path).select("name", "pairs", "vols")


@query("SELECT DISTINCT lower(trim(key)) AS token FROM s2_readings WHERE trim(key) <> ''")
def vocabulary_back(s: SparkSession, d: str) -> DataFrame:
    path = _folder(s)
    table(s, d, "s2_readings").select(F.upper("key").alias("value")).write.text(path)
    return files.vocabulary(s, path)
