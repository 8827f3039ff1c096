"""The same results as plain SQL over the given tables, for checking."""

from __future__ import annotations

from textjury.operators.voting import VERDICT_NOT_SPAM, VERDICT_SPAM
from textjury.plans.queries import BUCKETS, COLLISION_SIZES, DISCOVERY, FREQUENT, MEMBER_WEIGHTS, SIMILAR_ROWS
from textjury.plans.workbench import FOLDS


def _bucket(text: str, n: int) -> str:
    return f"CAST((('0x' || substr(md5({text}), 1, 8))::BIGINT) % {n} AS INTEGER)"


FOLD = _bucket("CAST(doc_id AS VARCHAR)", FOLDS)
LABELLED = """
    SELECT d.doc_id, CAST(l.toxic AS DOUBLE) AS label, d.text
    FROM documents d JOIN labels l ON d.doc_id = l.doc_id WHERE l.toxic IS NOT NULL"""
UNLABELLED = """
    SELECT doc_id, text FROM documents d
    WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)"""
WORDS = r"regexp_extract_all(lower(text), '[\p{L}\p{N}]+')"
KEEP_ALL = r"regexp_extract_all(text, '[\p{L}\p{N}]+|[^\p{L}\p{N}]')"
ONE_LINE = r"regexp_replace(text, '[\r\n]+', ' ', 'g')"
STRIPPED = (
    r"regexp_replace(text, '^[\t-\r\x1c-\x20\x{85}\p{Z}]+|[\t-\r\x1c-\x20\x{85}\p{Z}]+$', '', 'g')"
)
TOKENS = f"SELECT doc_id, unnest({WORDS}) AS token FROM documents"
LABELLED_TOKENS = f"SELECT doc_id, {FOLD} AS fold, unnest({WORDS}) AS token FROM ({LABELLED})"
TF = f"""
    SELECT doc_id, {_bucket('token', BUCKETS)} AS bucket, count(*) AS tf
    FROM ({TOKENS}) GROUP BY ALL"""
IDF = f"""
    SELECT bucket, count(*) AS df,
           ln(((SELECT count(*) FROM documents) + 1) / (count(*) + 1)) AS idf
    FROM ({TF}) GROUP BY bucket"""
FOLD_ROWS = f"SELECT doc_id, label, {FOLD} AS fold FROM ({LABELLED})"
HELD_OUT = f"SELECT CAST(range AS INTEGER) AS held_out FROM range({FOLDS})"
REQUESTS = f"""
    SELECT conv_id, turn, {STRIPPED} AS message,
           ['SVM', 'MP', 'LR', 'DT', 'GBDT', 'KNN'][(conv_id + turn) % 6 + 1] AS method
    FROM conversations"""
OK = "length(message) BETWEEN 1 AND 50 AND method IN ('SVM', 'MP', 'LR', 'DT', 'GBDT')"
JUDGED = f"""
    SELECT {FOLD} AS fold, algorithm, CAST(toxic AS DOUBLE) AS label,
           CASE algorithm WHEN 'low_quality' THEN 1.0 - quality WHEN 'never' THEN 0.0
                          WHEN 'always' THEN 1.0 ELSE 1.0 - toxic END AS prediction
    FROM labels, (SELECT unnest(['low_quality', 'never', 'always', 'opposite']) AS algorithm)"""
CONFUSION = f"""
    SELECT algorithm, fold,
           count(*) FILTER (label = 1 AND prediction = 1) AS tp,
           count(*) FILTER (label <> 1 AND prediction = 1) AS fp,
           count(*) FILTER (label <> prediction AND prediction <> 1) AS fn
    FROM ({JUDGED}) GROUP BY ALL"""
METRICS = f"""
    SELECT *, CASE WHEN precision + recall = 0 THEN 1.0
                   ELSE 2 * precision * recall / (precision + recall) END AS f1
    FROM (SELECT *, CASE WHEN tp + fp = 0 THEN 1.0 ELSE tp / (tp + fp) END AS precision,
                    CASE WHEN tp + fn = 0 THEN 1.0 ELSE tp / (tp + fn) END AS recall
          FROM ({CONFUSION}))"""
ALGORITHM_NAMES = "SELECT unnest(['SVM', 'MP', 'LR', 'DT', 'GBDT']) AS algorithm"


def _members(k: int) -> list[str]:
    return [_bucket(f"'{i}-' || CAST(doc_id AS VARCHAR)", 2) for i in range(k)]


def _majority(k: int) -> str:
    votes = " + ".join(_members(k))
    return f"""
        SELECT doc_id, votes, CAST(votes > {k // 2} AS INTEGER) AS vote
        FROM (SELECT doc_id, CAST({votes} AS INTEGER) AS votes FROM documents)"""


def _weighted() -> str:
    share = " + ".join(
        f"CASE WHEN {p} = 1 THEN {w}::DOUBLE ELSE 0 END"
        for p, w in zip(_members(len(MEMBER_WEIGHTS)), MEMBER_WEIGHTS)
    )
    half = sum(MEMBER_WEIGHTS) / 2
    return f"SELECT doc_id, CAST({share} > {half}::DOUBLE AS INTEGER) AS vote FROM documents"


def _collisions(m: int) -> str:
    return f"""
        SELECT CAST({m} AS INTEGER) AS num_buckets, CAST(sum(n) AS BIGINT) AS n_words,
               count(*) AS n_buckets_used,
               CAST(coalesce(sum(n) FILTER (n > 1), 0) AS BIGINT) AS n_colliding
        FROM (SELECT {_bucket('token', m)} AS bucket, count(*) AS n
              FROM (SELECT DISTINCT token FROM ({TOKENS})) GROUP BY 1)"""


def _from_counts(members: int) -> str:
    names = [f"p{i}" for i in range(members + 1)]
    said = ", ".join(f"{p} AS {n}" for p, n in zip([*_members(members), "1 - toxic"], names))
    weights = ", ".join(
        f"""CASE WHEN count(*) FILTER ({n} = 1 AND toxic = 1) = 0 THEN 0::DOUBLE
                 ELSE 2 * count(*) FILTER ({n} = 1 AND toxic = 1)
                      / (2 * count(*) FILTER ({n} = 1 AND toxic = 1) + count(*) FILTER ({n} <> toxic))
            END AS w{n}"""
        for n in names
    )
    share = " + ".join(f"CASE WHEN {n} = 1 THEN w{n} ELSE 0::DOUBLE END" for n in names)
    return f"""
        WITH r AS (SELECT doc_id, toxic, {said} FROM labels WHERE toxic IS NOT NULL),
        w AS (SELECT {weights} FROM r)
        SELECT doc_id, CAST({share} > ({' + '.join(f'w{n}' for n in names)}) / 2 AS INTEGER) AS vote FROM r, w"""


MARKER_COUNTS = f"""
    SELECT fold, count(*) FILTER (label = 1) AS tp, CAST(0 AS BIGINT) AS fp, CAST(0 AS BIGINT) AS fn
    FROM ({FOLD_ROWS}) GROUP BY fold"""
MARGINS = f"SELECT count(*) AS n_rows, CAST(0 AS BIGINT) AS n_mismatch FROM ({LABELLED})"

ORACLE: dict[str, str] = {
    "labelled_messages": LABELLED,
    "unlabelled_texts": UNLABELLED,
    "labelled_and_unlabelled_cover_all": """
        SELECT (SELECT count(*) FROM documents) AS n_found,
               (SELECT count(*) FROM documents d JOIN labels l ON d.doc_id = l.doc_id
                WHERE toxic IS NOT NULL AND d.doc_id % 10 <> 0) AS n_labelled,
               CAST(0 AS BIGINT) AS n_both, CAST(0 AS BIGINT) AS n_neither""",
    "parse_labelled_lines": """
        SELECT d.doc_id, CAST(l.toxic AS DOUBLE) AS label, d.source || chr(9) || d.text AS text
        FROM documents d JOIN labels l ON d.doc_id = l.doc_id""",
    "parse_quarantine": """
        SELECT d.doc_id,
               CASE WHEN l.toxic IS NOT NULL THEN 'parsed'
                    WHEN d.lang = 'en' THEN 'label is not a number'
                    ELSE 'no tab between label and text' END AS status,
               CASE WHEN l.toxic IS NULL AND d.lang = 'en' THEN length(d.text) + 3
                    ELSE length(d.text) END AS n_chars
        FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
    "labelled_file_scan": f"""
        SELECT md5(CAST(CAST(label AS INTEGER) AS VARCHAR) || chr(9) || line) AS doc_id,
               label, line AS text
        FROM (SELECT label, {ONE_LINE} AS line FROM ({LABELLED}))""",
    "message_file_scan": f"""
        SELECT {ONE_LINE} AS text, count(*) AS n FROM ({UNLABELLED}) GROUP BY 1""",
    "first_n_messages": "SELECT doc_id, text FROM documents ORDER BY doc_id LIMIT 100",
    "request_validation": f"""
        SELECT conv_id, turn, method, message, CAST({OK} AS INTEGER) AS ok FROM ({REQUESTS})""",
    "verdict_text": f"""
        SELECT conv_id, turn, vote,
               CASE vote WHEN 1 THEN '{VERDICT_SPAM}' ELSE '{VERDICT_NOT_SPAM}' END AS verdict
        FROM (SELECT conv_id, turn, {_bucket('message', 2)} AS vote FROM ({REQUESTS}) WHERE {OK})""",
    "clean_text": r"""
        SELECT doc_id, trim(regexp_replace(regexp_replace(text, '[\p{Cf}\p{Co}]+', '', 'g'),
                                           '[\p{Cc}\p{Z}]+', ' ', 'g')) AS text_clean
        FROM documents""",
    "tokenize_words": f"""
        SELECT doc_id, CAST(pos - 1 AS INTEGER) AS pos, words[pos] AS token
        FROM (SELECT doc_id, words, unnest(range(1, len(words) + 1)) AS pos
              FROM (SELECT doc_id, {WORDS} AS words FROM documents))""",
    "tokenize_keep_all": f"""
        SELECT doc_id, CAST(len(words) AS BIGINT) AS n_tokens,
               md5(array_to_string(words, '|')) AS tokens_md5
        FROM (SELECT doc_id, {KEEP_ALL} AS words FROM documents)""",
    "tokenize_char_bigrams": r"""
        SELECT doc_id, gram, count(*) AS n
        FROM (SELECT doc_id, unnest(list_transform(range(1, len(c)), lambda i: c[i] || c[i + 1])) AS gram
              FROM (SELECT doc_id, regexp_extract_all(text, '(?s).') AS c FROM documents))
        GROUP BY ALL""",
    "tokenize_dictionary": r"""
        WITH RECURSIVE known AS (
            SELECT DISTINCT token, length(token) AS size
            FROM (SELECT unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}]+')) AS token
                  FROM benchmark)
            WHERE length(token) > 1),
        placed AS (
            SELECT doc_id, unnest(regexp_extract_all(
                lower(text), '\p{L}+|\p{N}+|[^\p{L}\p{N}]')) AS piece
            FROM documents),
        runs AS (SELECT DISTINCT piece FROM placed WHERE regexp_matches(piece, '^\p{L}')),
        starts AS (SELECT piece, unnest(range(1, length(piece) + 1)) AS spot FROM runs),
        spans AS (
            SELECT piece, spot, unnest(range(2, least((SELECT max(size) FROM known),
                                                    length(piece) - spot + 1) + 1)) AS size
            FROM starts),
        longest AS (
            SELECT piece, spot, max(spans.size) AS size
            FROM spans JOIN known ON substring(piece, spot, spans.size) = token GROUP BY ALL),
        steps AS (
            SELECT s.piece, s.spot, coalesce(l.size, 1) AS size
            FROM starts s LEFT JOIN longest l ON s.piece = l.piece AND s.spot = l.spot),
        walk AS (
            SELECT piece, spot, size FROM steps WHERE spot = 1
            UNION ALL
            SELECT s.piece, s.spot, s.size FROM walk w JOIN steps s
            ON s.piece = w.piece AND s.spot = w.spot + w.size),
        cut AS (SELECT piece, substring(piece, spot, size) AS token FROM walk)
        SELECT doc_id, coalesce(cut.token, placed.piece) AS token, count(*) AS n
        FROM placed LEFT JOIN cut ON placed.piece = cut.piece GROUP BY ALL""",
    "vocabulary": f"""
        SELECT token, count(*) AS term_count, count(DISTINCT doc_id) AS doc_count
        FROM ({TOKENS}) GROUP BY token""",
    "hash_collisions": " UNION ALL ".join(_collisions(m) for m in COLLISION_SIZES),
    "fold_assignment": f"SELECT doc_id, {FOLD} AS fold FROM documents",
    "fold_by_text": f"""SELECT doc_id, {_bucket("'text:' || md5(text)", FOLDS)} AS fold FROM documents""",
    "fold_balance": f"SELECT fold, label, count(*) AS n FROM ({FOLD_ROWS}) GROUP BY ALL",
    "leave_one_out_train_counts": f"""
        SELECT held_out, count(*) AS n_train, count(*) FILTER (label = 1) AS n_pos
        FROM ({HELD_OUT}) JOIN ({FOLD_ROWS}) ON fold <> held_out GROUP BY held_out""",
    "leave_one_out_train_rows": f"""
        SELECT held_out, doc_id, label FROM ({HELD_OUT}) JOIN ({FOLD_ROWS}) ON fold <> held_out""",
    "split_roundtrip": f"""
        SELECT {FOLD} AS fold, count(*) AS n, CAST(sum(len({KEEP_ALL})) AS BIGINT) AS n_tokens
        FROM ({LABELLED}) GROUP BY 1""",
    "hashed_tf": TF,
    "document_frequency": f"SELECT bucket, df FROM ({IDF})",
    "idf_all": f"SELECT bucket, df, round(idf, 6) AS idf FROM ({IDF})",
    "idf_leave_one_out": f"""
        WITH held AS (
            SELECT DISTINCT doc_id, fold, {_bucket('token', BUCKETS)} AS bucket
            FROM ({LABELLED_TOKENS})),
        sizes AS (
            SELECT held_out, count(*) AS m FROM ({HELD_OUT}) JOIN ({FOLD_ROWS}) ON fold <> held_out
            GROUP BY held_out),
        counts AS (
            SELECT held_out, m, bucket, count(*) FILTER (fold <> held_out) AS df
            FROM sizes, held GROUP BY ALL)
        SELECT held_out, bucket, df, round(ln((m + 1) / (df + 1)), 6) AS idf FROM counts""",
    "tfidf": f"""
        SELECT doc_id, t.bucket, round(tf * idf, 6) AS tfidf
        FROM ({TF}) t JOIN ({IDF}) i ON t.bucket = i.bucket""",
    "term_vector_totals": f"""
        SELECT doc_id, {FOLD} AS fold, CAST(len({KEEP_ALL}) AS BIGINT) AS n_tokens FROM ({LABELLED})""",
    "majority_vote": _majority(5),
    "majority_vote_even_k": _majority(4),
    "weighted_vote": _weighted(),
    "confusion_counts": CONFUSION,
    "precision_recall_f1": f"""
        SELECT algorithm, fold, tp, fp, fn, round(precision, 6) AS precision,
               round(recall, 6) AS recall, round(f1, 6) AS f1
        FROM ({METRICS})""",
    "macro_metrics": f"""
        SELECT algorithm, round(avg(precision), 6) AS precision, round(avg(recall), 6) AS recall,
               round(avg(f1), 6) AS f1
        FROM ({METRICS}) GROUP BY algorithm""",
    "out_of_fold_rows": f"""
        SELECT algorithm, doc_id, fold, label FROM ({FOLD_ROWS}), ({ALGORITHM_NAMES})""",
    "run_records": f"""
        SELECT algorithm, fold, count(*) FILTER (label = 1) AS n_positive
        FROM ({FOLD_ROWS}), ({ALGORITHM_NAMES}) GROUP BY ALL""",
    "model_roundtrip": "SELECT count(*) AS n_rows, CAST(0 AS BIGINT) AS n_mismatch FROM documents",
    "stream_equals_batch": "SELECT count(*) AS n_rows, CAST(0 AS BIGINT) AS n_mismatch FROM documents",
    "stream_requests_accepted": f"""
        SELECT conv_id, turn, method, CAST({OK} AS INTEGER) AS ok, CAST({OK} AS INTEGER) AS answered
        FROM ({REQUESTS})""",
    "stream_ingest": f"""
        SELECT md5(concat_ws(chr(9), CAST(label AS VARCHAR), line)) AS doc_id,
               CASE WHEN label IS NULL THEN 'no tab between label and text'
                    WHEN label = 2 THEN 'label is not 0 or 1' ELSE CAST(label AS VARCHAR) END AS status
        FROM (SELECT CASE WHEN toxic IS NOT NULL AND d.doc_id % 17 = 0 THEN 2 ELSE toxic END AS label,
                     {ONE_LINE} AS line
              FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)""",
    "weighted_vote_from_counts": _from_counts(5),
    "marker_cv_dt": MARKER_COUNTS,
    "marker_cv_gbdt": MARKER_COUNTS,
    "lr_margins": MARGINS,
    "svm_margins": MARGINS,
    "mp_margins": MARGINS,
    "vote_consistency": f"""
        SELECT algorithm, (SELECT count(*) FROM documents) AS n_rows, CAST(0 AS BIGINT) AS n_mismatch
        FROM ({ALGORITHM_NAMES})""",
    "training_sizes": f"""
        SELECT algorithm, CAST({FOLDS} AS INTEGER) AS k,
               CAST(CASE algorithm WHEN 'MP' THEN 1000 ELSE 10000 END AS INTEGER) AS num_features,
               (SELECT count(*) FROM ({LABELLED})) AS n_rows
        FROM ({ALGORITHM_NAMES})""",
}
BENCHMARK_WORDS = r"SELECT regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS words FROM benchmark"


def _places(words: str) -> str:
    """CTEs up to ``counted`` (kind, place, mark, n), from a query that gives arrays of ``words``."""
    return rf"""
        spelled AS (
            SELECT list_reduce([''] || list_transform(words, lambda w: CASE
                       WHEN NOT regexp_matches(w, '^\p{{L}}+$') THEN ' ' WHEN length(w) = 1 THEN 'S'
                       ELSE 'B' || repeat('M', length(w) - 2) || 'E' END), lambda x, y: x || y) AS places,
                   list_reduce([''] || list_transform(words, lambda w: CASE
                       WHEN NOT regexp_matches(w, '^\p{{L}}+$') THEN ' ' ELSE w END), lambda x, y: x || y) AS shown
            FROM ({words})),
        spots AS (
            SELECT unnest([' '] || regexp_extract_all(places, '.')) AS before,
                   unnest(regexp_extract_all(places, '.')) AS place, unnest(regexp_extract_all(shown, '.')) AS mark
            FROM spelled),
        counted AS (
            SELECT 'start' AS kind, place, '' AS mark, count(*) AS n FROM spots WHERE before = ' ' AND place <> ' ' GROUP BY ALL
            UNION ALL
            SELECT 'step', before, place, count(*) FROM spots WHERE before <> ' ' AND place <> ' ' GROUP BY ALL
            UNION ALL
            SELECT 'emit', place, mark, count(*) FROM spots WHERE place <> ' ' GROUP BY ALL)"""


def _chance(kind: str, place: str, mark: str, total: str) -> str:
    return f"ln((coalesce((SELECT n FROM counted WHERE kind = '{kind}' AND place = '{place}' AND mark = '{mark}'), 0) + 1) / ({total}))"


def _unknown_words() -> str:
    """The likeliest places of every stretch, character by character, with the whole path in the state."""
    before = {"B": "ES", "M": "BM", "E": "BM", "S": "ES"}
    sums = ", ".join(
        f"(SELECT coalesce(sum(n), 0) FROM counted WHERE kind = 'emit' AND place = '{p}') AS total_{p}" for p in "BMES"
    )
    after = lambda p: " + ".join(
        f"coalesce((SELECT n FROM counted WHERE kind = 'step' AND place = '{p}' AND mark = '{q}'), 0)" for q in "BMES" if p in before[q]
    )
    starts = "(SELECT coalesce(sum(n), 0) FROM counted WHERE kind = 'start' AND place IN ('B', 'S')) + 2"
    logs = [f"{_chance('start', p, '', starts)} AS start_{p}" for p in "BS"]
    logs += [f"{_chance('step', p, q, after(p) + ' + 2')} AS step_{p}{q}" for q in "BMES" for p in before[q]]
    of = lambda p: f"coalesce(e.emit_{p}, ln(1 / (t.total_{p} + t.letters + 1)))"
    state = lambda scores, paths: "struct_pack(" + ", ".join(
        f"s{p} := ({scores[p]})::DOUBLE, p{p} := {paths[p]}" for p in "BMES"
    ) + ")"
    element = state({p: f"list_extract(emits, i)['{p}']" for p in "BMES"}, {p: "''" for p in "BMES"})
    first = state(
        {p: f"start_{p} + list_extract(emits, 1)['{p}']" if p in "BS" else f"-1e300::DOUBLE + list_extract(emits, 1)['{p}']" for p in "BMES"},
        {p: f"'{p}'" for p in "BMES"},
    )
    better = lambda p: "{0} >= {1}".format(*[f"a.s{q} + step_{q}{p}" for q in before[p]])
    scores = {p: f"CASE WHEN {better(p)} THEN a.s{before[p][0]} + step_{before[p][0]}{p} ELSE a.s{before[p][1]} + step_{before[p][1]}{p} END + x.s{p}" for p in "BMES"}
    paths = {p: f"(CASE WHEN {better(p)} THEN a.p{before[p][0]} ELSE a.p{before[p][1]} END) || '{p}'" for p in "BMES"}
    walk = ORACLE["tokenize_dictionary"]
    words = walk[: walk.index("cut AS (")].replace("WITH RECURSIVE known", "known", 1)
    return rf"""
        WITH RECURSIVE {words}
        tokens AS (SELECT piece, spot, size, spot - row_number() OVER (PARTITION BY piece, size = 1 ORDER BY spot) AS gap FROM walk),
        stretches AS (
            SELECT piece, min(spot) AS spot, count(*) AS size, substring(piece, min(spot), count(*)) AS stretch
            FROM tokens WHERE size = 1 GROUP BY piece, gap),
        {_places(BENCHMARK_WORDS)},
        totals AS (SELECT {sums}, (SELECT count(DISTINCT mark) FROM counted WHERE kind = 'emit') AS letters),
        logs AS (SELECT {', '.join(logs)}),
        emits AS (
            SELECT mark, {', '.join(f"ln((coalesce(sum(n) FILTER (place = '{p}'), 0) + 1) / (any_value(total_{p}) + any_value(letters) + 1)) AS emit_{p}" for p in 'BMES')}
            FROM counted, totals WHERE kind = 'emit' GROUP BY mark),
        letters AS (
            SELECT DISTINCT stretch, unnest(range(1, length(stretch) + 1)) AS i FROM stretches),
        shown AS (
            SELECT stretch, list(struct_pack({', '.join(f'"{p}" := {of(p)}' for p in 'BMES')}) ORDER BY i) AS emits
            FROM letters CROSS JOIN totals t LEFT JOIN emits e ON e.mark = substring(stretch, i, 1) GROUP BY stretch),
        ended AS (
            SELECT stretch, list_reduce(list_transform(range(2, len(emits) + 1), lambda i: {element}),
                       lambda a, x: {state(scores, paths)}, {first}) AS a
            FROM shown CROSS JOIN logs),
        likeliest AS (
            SELECT stretch, regexp_extract_all(CASE WHEN a.sE >= a.sS THEN a.pE ELSE a.pS END, 'S|BM*E') AS words FROM ended),
        again AS (
            SELECT piece, spot, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS nth
            FROM stretches JOIN likeliest USING (stretch)),
        recut AS (
            SELECT piece, (spot + sum(length(word)) OVER (PARTITION BY piece, spot ORDER BY nth) - length(word))::BIGINT AS spot, length(word) AS size
            FROM again),
        cut AS (
            SELECT piece, list(substring(piece, spot, size) ORDER BY spot) AS tokens
            FROM (SELECT piece, spot, size FROM tokens WHERE size > 1 UNION ALL SELECT piece, spot, size FROM recut) GROUP BY piece),
        numbered AS (
            SELECT doc_id, unnest(pieces) AS piece, unnest(range(1, len(pieces) + 1)) AS pos
            FROM (SELECT doc_id, regexp_extract_all(lower(text), '\p{{L}}+|\p{{N}}+|[^\p{{L}}\p{{N}}]') AS pieces FROM documents)),
        whole AS (
            SELECT doc_id, flatten(list(coalesce(tokens, [n.piece]) ORDER BY pos)) AS tokens
            FROM numbered n LEFT JOIN cut ON cut.piece = n.piece GROUP BY doc_id)
        SELECT d.doc_id, coalesce(len(tokens), 0)::BIGINT AS n_tokens, md5(coalesce(array_to_string(tokens, '|'), '')) AS tokens_md5
        FROM documents d LEFT JOIN whole USING (doc_id)"""


def _discovery(max_length: int, min_count: int, min_cohesion: float, min_entropy: float) -> str:
    sizes = ", ".join(str(n) for n in range(1, max_length + 2))
    return rf"""
        WITH runs AS (
            SELECT chr(2) || unnest(regexp_extract_all(regexp_replace(lower(text), '[ 
]+', '', 'g'), '\p{{L}}+')) || chr(3) AS run
            FROM documents),
        sizes AS (SELECT unnest([{sizes}]) AS size),
        grams AS (
            SELECT gram, length(gram) AS size, count(*) AS n
            FROM (SELECT unnest(list_transform(range(1, length(run) - size + 2), lambda i: substring(run, i, size))) AS gram
                  FROM runs CROSS JOIN sizes) GROUP BY gram),
        inside AS (SELECT * FROM grams WHERE size <= {max_length} AND NOT regexp_matches(gram, '[]')),
        totals AS (SELECT size, sum(n) AS total FROM inside GROUP BY size),
        candidates AS (SELECT gram, i.size, n, ln(n / total) AS own FROM inside i JOIN totals t ON i.size = t.size
                       WHERE i.size > 1 AND n >= {min_count}),
        halves AS (SELECT gram, size, unnest(range(1, size)) AS spot FROM candidates),
        chances AS (
            SELECT h.gram, max(ln(a.n / ta.total) + ln(b.n / tb.total)) AS chance
            FROM halves h JOIN inside a ON a.gram = substring(h.gram, 1, spot) JOIN inside b ON b.gram = substring(h.gram, spot + 1)
            JOIN totals ta ON ta.size = a.size JOIN totals tb ON tb.size = b.size GROUP BY h.gram),
        before AS (
            SELECT substring(gram, 2) AS gram, ln(sum(n)) - sum(n * ln(n)) / sum(n) AS entropy
            FROM grams WHERE size > 2 AND NOT ends_with(gram, chr(3)) GROUP BY 1),
        after AS (
            SELECT substring(gram, 1, size - 1) AS gram, ln(sum(n)) - sum(n * ln(n)) / sum(n) AS entropy
            FROM grams WHERE size > 2 AND NOT starts_with(gram, chr(2)) GROUP BY 1)
        SELECT c.gram AS token, c.n AS term_count, round(own - chance, 4) AS cohesion,
               round(b.entropy, 4) AS left_entropy, round(a.entropy, 4) AS right_entropy
        FROM candidates c JOIN chances USING (gram) JOIN before b USING (gram) JOIN after a USING (gram)
        WHERE own - chance >= {min_cohesion} AND least(b.entropy, a.entropy) >= {min_entropy}"""


ORACLE["marker_cv_dt_selected"] = MARKER_COUNTS
ORACLE["boosted_marker_cv"] = MARKER_COUNTS
ORACLE["nested_vote_metrics"] = MARKER_COUNTS
ORACLE["incremental_idf"] = ORACLE["idf_leave_one_out"]
ORACLE["boosted_alphas"] = MARGINS
ORACLE["windowed_spam_rate"] = f"""
    SELECT epoch(date_trunc('hour', ts))::BIGINT AS window_start, count(*) AS n, sum(vote)::BIGINT AS n_spam,
           round(sum(vote) / count(*), 6) AS spam_rate
    FROM events JOIN ({_majority(5)}) ON user_id = doc_id GROUP BY 1"""
ORACLE["chi_square_by_fold"] = f"""
    WITH held AS (
        SELECT DISTINCT doc_id, {_bucket('token', BUCKETS)} AS bucket
        FROM (SELECT doc_id, unnest({WORDS}) AS token FROM ({LABELLED}))),
    sets AS (SELECT held_out, doc_id, label FROM ({HELD_OUT}) JOIN ({FOLD_ROWS}) ON fold <> held_out),
    sizes AS (SELECT held_out, count(*)::DOUBLE AS n, count(*) FILTER (label = 1)::DOUBLE AS pos FROM sets GROUP BY held_out),
    cells AS (
        SELECT held_out, bucket, count(*)::DOUBLE AS have, count(*) FILTER (label = 1)::DOUBLE AS hits
        FROM sets JOIN held USING (doc_id) GROUP BY ALL),
    every AS (SELECT held_out, bucket FROM ({HELD_OUT}) CROSS JOIN (SELECT DISTINCT bucket FROM held))
    SELECT held_out, bucket, coalesce(have, 0)::BIGINT AS df,
           CASE WHEN coalesce(have, 0) * (n - coalesce(have, 0)) * pos * (n - pos) > 0
                THEN round(n * (hits * (n - have - pos + hits) - (have - hits) * (pos - hits))
                           * (hits * (n - have - pos + hits) - (have - hits) * (pos - hits))
                           / (have * (n - have) * pos * (n - pos)), 4)
                ELSE 0 END::DOUBLE AS chi_square
    FROM every JOIN sizes USING (held_out) LEFT JOIN cells USING (held_out, bucket)"""
ORACLE["place_counts"] = f"""
    WITH {_places(f"SELECT {WORDS} AS words FROM documents")}
    SELECT kind, place, mark, n FROM counted"""
ORACLE["segment_unknown_words"] = _unknown_words()
ORACLE["word_discovery"] = _discovery(**DISCOVERY)
ORACLE["segment_with_discovered_words"] = r"""
    SELECT doc_id, md5(regexp_replace(lower(text), '[ 
]+', '', 'g')) AS text_md5 FROM documents"""
ORACLE["tokenize_dictionary_joined"] = ORACLE["tokenize_dictionary"]
ORACLE["dictionary_split_roundtrip"] = f"""
    SELECT fold, count(*) AS n, CAST(sum(coalesce(n_tokens, 0)) AS BIGINT) AS n_tokens
    FROM ({FOLD_ROWS}) r
    LEFT JOIN (SELECT doc_id, sum(n) AS n_tokens FROM ({ORACLE['tokenize_dictionary']}) GROUP BY doc_id) t
    ON r.doc_id = t.doc_id GROUP BY fold"""
ORACLE["frequent_words"] = f"""
    SELECT token, count(*) AS term_count, count(DISTINCT doc_id) AS doc_count
    FROM ({TOKENS}) GROUP BY token HAVING count(*) >= {FREQUENT}"""
ORACLE["sketch_error"] = f"""
    SELECT count(DISTINCT token) AS n_words, count(*) AS n_terms,
           CAST(0 AS BIGINT) AS n_below, CAST(1 AS INTEGER) AS within_bound
    FROM ({TOKENS})"""
_LEAST = " || ".join(f"substr(min(md5('{row}:' || gram)), 1, 8)" for row in range(SIMILAR_ROWS))
ORACLE["similar_word_buckets"] = f"""
    WITH words AS (SELECT DISTINCT token FROM ({TOKENS})),
    places AS (SELECT token, unnest(range(1, length(token) + 2)) AS place FROM words),
    grams AS (SELECT token, substring(chr(2) || token || chr(3), place, 2) AS gram FROM places),
    signatures AS (SELECT token, {_LEAST} AS signature FROM grams GROUP BY token)
    SELECT token, {_bucket('signature', COLLISION_SIZES[-1])} AS bucket FROM signatures"""
ORACLE["similar_marker_cv"] = MARKER_COUNTS
