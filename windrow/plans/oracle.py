"""The registered queries in SQL, over views of the given tables, for checking results."""

from __future__ import annotations

WORDS = "list_filter(string_split(text, ' '), lambda x: x <> '')"
DOUBLES = "embedding::DOUBLE[]"
LENGTHS = f"list_transform({WORDS}, lambda t: length(t)::DOUBLE)"


def as_text(vector: str) -> str:
    return f"array_to_string(list_transform({vector}, lambda x: round(x * 1000000)::BIGINT), ',')"


def unit(text: str, at: str = "1") -> str:
    return f"(('0x' || substr(md5({text}), {at}, 8))::BIGINT / 4294967296::DOUBLE)"


def made_vector(token: str, width: int = 8, seed: int = 12345) -> str:
    """Element j comes from slice j % 4 of the digest for j div 4."""
    element = unit(f"'{seed}:' || {token} || ':' || (j // 4)::VARCHAR", "(j % 4) * 8 + 1")
    return f"list_transform(range({width}), lambda j: {element})"


def position_code(position: str, width: int = 64, per_slot: int = 2) -> str:
    angle = f"({position}::DOUBLE / pow(10000::DOUBLE, {per_slot}::DOUBLE * (j - j % 2)::DOUBLE / {width}::DOUBLE))"
    return (
        f"list_transform(range({width}), lambda j: CASE WHEN j % 2 = 0 THEN sin{angle} ELSE cos{angle} END)"
    )


def add(a: str, b: str) -> str:
    return f"list_transform(list_zip({a}, {b}), lambda p: p[1] + p[2])"


def split_index(key: str, bounds: tuple[float, ...], seed: int) -> str:
    at = unit(f"'{seed}:' || {key}")
    return " + ".join(f"({at} >= {b!r}::DOUBLE)::INT" for b in bounds)


def fit(vector: str, width: int) -> str:
    return f"list_resize({vector}, {width}, 0::DOUBLE)"


def array_windows(table: str, key: str, width: int, items: str) -> str:
    """key, start, ctx list, target, from one list per row."""
    return f"""
        SELECT {key}, s AS start, t[s + 1 : s + {width}] AS ctx, t[s + {width} + 1] AS target
        FROM (
            SELECT {key}, t, unnest(range(len(t) - {width})) AS s
            FROM (SELECT {key}, {items} AS t FROM {table}) WHERE len(t) > {width}
        )"""


def row_windows(rows: str, width: int, value: str, order: str, seq: str | None = None) -> str:
    """seq, start, ctx list, target, from one row per item."""
    part = f"PARTITION BY {seq} " if seq else ""
    keep = f"{seq}, " if seq else ""
    return f"""
        SELECT {keep}n - {width} AS start, ctx, target FROM (
            SELECT {keep}{value} AS target,
                row_number() OVER ({part}ORDER BY {order}) - 1 AS n,
                list({value}) OVER ({part}ORDER BY {order}
                    ROWS BETWEEN {width} PRECEDING AND 1 PRECEDING) AS ctx
            FROM {rows}
        ) WHERE len(ctx) = {width}"""


DOCUMENT_WINDOWS = array_windows("documents", "doc_id", 4, WORDS)
JOINED = "array_to_string(ctx, ' ') AS ctx, target"
TOKENS = f"(SELECT doc_id, unnest({WORDS}) AS token FROM documents)"
EMBEDDING_WINDOWS = row_windows(f"(SELECT vec_id, {DOUBLES} AS e FROM embeddings)", 4, "e", "vec_id")
CODES = "flatten(list_transform(range(4), lambda k: {}))".format(position_code("k"))
EMBEDDING_EXAMPLES = f"SELECT start, {add('flatten(ctx)', CODES)} AS features, target AS label FROM ({EMBEDDING_WINDOWS})"
PAIRS = f"""SELECT start, ctx[1] AS pred, target AS label
    FROM ({row_windows(f"(SELECT vec_id, {DOUBLES} AS e FROM embeddings)", 1, "e", "vec_id")})"""
MADE_CODES = "flatten(list_transform(range(4), lambda k: {}))".format(position_code("k", 8))
NORM_PRED = "sqrt(list_sum(list_transform(pred, lambda x: x * x)))"
NORM_LABEL = "sqrt(list_sum(list_transform(label, lambda x: x * x)))"
DOT = "list_sum(list_transform(list_zip(pred, label), lambda p: p[1] * p[2]))"
COSINE = f"""CASE WHEN {NORM_PRED} * {NORM_LABEL} > 0
    THEN {DOT} / ({NORM_PRED} * {NORM_LABEL}) ELSE 0::DOUBLE END"""

ATTACHED = f"""
    WITH tokens AS (SELECT * FROM {TOKENS}),
    vocabulary AS (SELECT token, {made_vector("token")} AS v FROM (SELECT DISTINCT token FROM tokens))
    SELECT doc_id, count(*) AS n_tokens,
        sum(round(v[1] * 1000000)::BIGINT)::BIGINT AS sum_first,
        sum(round(v[8] * 1000000)::BIGINT)::BIGINT AS sum_last
    FROM tokens JOIN vocabulary USING (token) GROUP BY doc_id"""

NUMBER = r"[ ]*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?[ ]*"
GOOD_LINE = (
    rf"regexp_full_match(line, '[+-]?[0-9]+\t\[?{NUMBER}(,{NUMBER})*,*\]?\t*')"
    r" AND TRY_CAST(regexp_extract(line, '^([^\t]*)\t', 1) AS INT) IS NOT NULL"
)



def made_weights(layer: int, rows: int, cols: int) -> str:
    """The weights of each unit as a list, in a list over units."""
    value = unit(f"'7:{layer}:weight:' || (i * {cols} + j)::VARCHAR")
    return (
        f"(SELECT list_transform(range({cols}), lambda j: list_transform(range({rows}), "
        f"lambda i: ({value} - 0.5::DOUBLE) * 0.2::DOUBLE)))"
    )


def made_biases(layer: int, cols: int) -> str:
    value = unit(f"'7:{layer}:bias:' || j::VARCHAR")
    return f"(SELECT list_transform(range({cols}), lambda j: ({value} - 0.5::DOUBLE) * 0.2::DOUBLE))"


def dense(x: str, layer: int, cols: int) -> str:
    return f"list_transform(range({cols}), lambda u: list_inner_product({x}, w{layer}[u + 1]) + b{layer}[u + 1])"


def relu(x: str) -> str:
    return f"list_transform({x}, lambda v: greatest(v, 0::DOUBLE))"


MADE_PREDICTIONS = f"""
    WITH model AS (SELECT {made_weights(0, 256, 64)} AS w0, {made_biases(0, 64)} AS b0,
        {made_weights(1, 64, 64)} AS w1, {made_biases(1, 64)} AS b1,
        {made_weights(2, 64, 64)} AS w2, {made_biases(2, 64)} AS b2),
    first AS (SELECT start, label, {relu(dense("features", 0, 64))} AS x FROM ({EMBEDDING_EXAMPLES}), model),
    second AS (SELECT start, label, {relu(dense("x", 1, 64))} AS x FROM first, model)
    SELECT start, label, {dense("x", 2, 64)} AS pred FROM second, model"""

def made_inputs(layer: int, rows: int, cols: int) -> str:
    """The same weights as a list over inputs, for the way back."""
    value = unit(f"'7:{layer}:weight:' || (i * {cols} + j)::VARCHAR")
    return (
        f"(SELECT list_transform(range({rows}), lambda i: list_transform(range({cols}), "
        f"lambda j: ({value} - 0.5::DOUBLE) * 0.2::DOUBLE)))"
    )


def behind(error: str, layer: int, rows: int, active: str) -> str:
    """The error of a layer's inputs, where they were active."""
    return (
        f"list_transform(range({rows}), lambda i: CASE WHEN {active}[i + 1] > 0 "
        f"THEN list_inner_product({error}, t{layer}[i + 1]) ELSE 0::DOUBLE END)"
    )


def gradient(layer: int, rows: int, cols: int, x: str, error: str) -> str:
    """``worker, layer, kind, place, g`` summed over the training rows of each worker."""
    return f"""
        SELECT worker, {layer} AS layer, 'weight' AS kind, i * {cols} + j AS place, sum({x}[i + 1] * {error}[j + 1]) AS g
        FROM backward, range({rows}) r(i), range({cols}) c(j) GROUP BY 1, 4
        UNION ALL SELECT worker, {layer}, 'bias', j, sum({error}[j + 1]) FROM backward, range({cols}) c(j) GROUP BY 1, 3, 4"""


#: A step of Adam for each of two workers, which has the length of the rate but for tiny gradients, and their average.
ONE_STEP = f"""
    model AS MATERIALIZED (SELECT {made_weights(0, 256, 64)} AS w0, {made_biases(0, 64)} AS b0,
        {made_weights(1, 64, 64)} AS w1, {made_biases(1, 64)} AS b1, {made_inputs(1, 64, 64)} AS t1,
        {made_weights(2, 64, 64)} AS w2, {made_biases(2, 64)} AS b2, {made_inputs(2, 64, 64)} AS t2),
    examples AS MATERIALIZED (
        SELECT *, {split_index("start", (0.8,), 42)} AS split,
            floor({unit("'1:' || (start - start % 32)")} * 2)::INT AS worker
        FROM ({EMBEDDING_EXAMPLES})
    ),
    first AS (SELECT *, {relu(dense("features", 0, 64))} AS x1 FROM examples, model WHERE split = 0),
    second AS (SELECT *, {relu(dense("x1", 1, 64))} AS x2 FROM first),
    third AS (SELECT *, {dense("x2", 2, 64)} AS pred, count(*) OVER (PARTITION BY worker) AS n FROM second),
    missed AS (
        SELECT *, list_transform(list_zip(pred, label), lambda p: (p[1] - p[2]) * 2::DOUBLE / (n * 64)) AS e2 FROM third
    ),
    middle AS (SELECT *, {behind("e2", 2, 64, "x2")} AS e1 FROM missed),
    backward AS MATERIALIZED (
        SELECT worker, n, features, x1, x2, e1, e2, {COSINE} > 0.1 AS hit, {behind("e1", 1, 64, "x1")} AS e0,
            list_avg(list_transform(list_zip(pred, label), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS loss
        FROM middle
    ),
    gradients AS MATERIALIZED (
        {gradient(0, 256, 64, "features", "e0")} UNION ALL {gradient(1, 64, 64, "x1", "e1")}
        UNION ALL {gradient(2, 64, 64, "x2", "e2")}
    ),
    stepped AS MATERIALIZED (
        SELECT layer, kind, place, ({unit("'7:' || layer || ':' || kind || ':' || place")} - 0.5::DOUBLE) * 0.2::DOUBLE
            - 0.001::DOUBLE * sum(n * g / (abs(g) + 1e-8::DOUBLE)) / sum(n) AS x
        FROM gradients JOIN (SELECT worker, count(*) AS n FROM backward GROUP BY worker) USING (worker)
        GROUP BY layer, kind, place
    )"""


def stepped_weights(layer: int) -> str:
    return (
        f"(SELECT list(unit ORDER BY j) FROM (SELECT place % 64 AS j, list(x ORDER BY place) AS unit "
        f"FROM stepped WHERE layer = {layer} AND kind = 'weight' GROUP BY 1))"
    )


def stepped_biases(layer: int) -> str:
    return f"(SELECT list(x ORDER BY place) FROM stepped WHERE layer = {layer} AND kind = 'bias')"


STEPPED_PREDICTIONS = f"""
    again AS MATERIALIZED (SELECT {", ".join(
        f"{stepped_weights(i)} AS w{i}, {stepped_biases(i)} AS b{i}" for i in range(3)
    )}),
    one AS (SELECT split, label, {relu(dense("features", 0, 64))} AS x FROM examples, again),
    two AS (SELECT split, label, {relu(dense("x", 1, 64))} AS x FROM one, again),
    three AS (SELECT split, label, {dense("x", 2, 64)} AS pred FROM two, again),
    judged AS (
        SELECT split, {COSINE} > 0.1 AS hit,
            list_avg(list_transform(list_zip(pred, label), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS e
        FROM three
    )"""

DAY_EPOCHS = """
    SELECT dayofmonth(ts)::INT AS epoch,
        avg(value) AS loss,
        100 * avg((event_type = 'click')::INT::DOUBLE) AS accuracy,
        CASE WHEN max(dayofmonth(ts) % 2) = 1
            THEN avg(CASE WHEN event_type = 'signup' THEN value END) END AS val_loss,
        CASE WHEN max(dayofmonth(ts) % 2) = 1
            THEN 100 * avg((event_type = 'view')::INT::DOUBLE) END AS val_accuracy,
        sqrt(sum(value * value)) AS g_norm, min(value) AS g_min, max(value) AS g_max,
        avg(value) AS g_mean, stddev_pop(value) AS g_std,
        0.001::DOUBLE AS learning_rate,
        (epoch_us(max(ts)) - epoch_us(min(ts))) // 1000 AS ms
    FROM events GROUP BY 1"""


def duration(ms: str) -> str:
    return f"""CASE
        WHEN {ms} >= 3600000 THEN ({ms} // 3600000) || 'h ' || ({ms} // 60000 % 60) || 'm ' || ({ms} // 1000 % 60) || 's'
        WHEN {ms} >= 60000 THEN ({ms} // 60000) || 'm ' || ({ms} // 1000 % 60) || 's'
        ELSE ({ms} // 1000) || 's' END"""


def fixed(value: str, digits: int, unit: str = "") -> str:
    """A number with fixed decimals; halves are rounded up, as the report does."""
    return f"printf('%.{digits}f{unit}', round({value}, {digits}))"


_LINES = [
    "''",
    "'Epoch ' || epoch || ':'",
    f"'  Loss: ' || {fixed('loss', 6)}",
    f"'  Accuracy: ' || {fixed('accuracy', 2, '%%')}",
    f"'  Validation Loss: ' || CASE WHEN val_loss IS NOT NULL THEN {fixed('val_loss', 6)} END",
    f"'  Validation Accuracy: ' || CASE WHEN val_accuracy IS NOT NULL THEN {fixed('val_accuracy', 2, '%%')} END",
    "'  Learning Rate: ' || printf('%.6e', learning_rate)",
    f"'  Duration: ' || {duration('ms')}",
    "'  Gradient Statistics:'",
    f"'    Norm: ' || {fixed('g_norm', 6)}",
    f"'    Min/Max: ' || {fixed('g_min', 6)} || ' / ' || {fixed('g_max', 6)}",
    f"'    Mean: ' || {fixed('g_mean', 6)}",
    f"'    Std Dev: ' || {fixed('g_std', 6)}",
]
REPORT = f"""
    WITH e AS ({DAY_EPOCHS})
    SELECT item, n, line FROM (
        {" UNION ALL ".join(f"SELECT epoch AS item, {n} AS n, {line} AS line FROM e" for n, line in enumerate(_LINES))}
    ) WHERE line IS NOT NULL"""

STAT_COLUMNS = """round(sqrt(sum(x * x)), 6) AS norm, round(min(x), 6) AS min, round(max(x), 6) AS max,
    round(avg(x), 6) AS mean"""


def codes_of(per_slot: int) -> str:
    return f"""SELECT vec_id AS position, unnest(range(64))::INT AS j,
        unnest(list_transform({position_code("vec_id", 64, per_slot)}, lambda x: round(x, 6))) AS x
        FROM embeddings"""


DOCUMENT_EXAMPLES = f"""
    WITH vocabulary AS (
        SELECT token, {made_vector("token")} AS v FROM (SELECT DISTINCT token FROM {TOKENS})),
    codes AS (SELECT {MADE_CODES} AS c),
    vectors AS (
        SELECT doc_id, i, v FROM (
            SELECT doc_id, unnest(range(len({WORDS}))) AS i, unnest({WORDS}) AS token FROM documents
        ) JOIN vocabulary USING (token))
    SELECT doc_id, start, md5({as_text(add("flatten(ctx)", "c"))}) AS features,
        {as_text("target")} AS label
    FROM ({row_windows("vectors", 4, "v", "i", "doc_id")}), codes"""

EVENT_RUN = """
    SELECT (epoch_us(max(ts)) - epoch_us(min(ts))) // 1000 AS total_ms, count(DISTINCT day(ts)) AS n_epochs,
        100 * avg((event_type = 'click')::INT::DOUBLE) AS accuracy, avg(value) AS loss,
        sum(round(value * 100)::BIGINT)::DOUBLE / count(*) AS ms_per_step,
        sum(round(value * 100)::BIGINT)::DOUBLE / sum(length(props)) AS ms_per_row,
        max(round(value * 100)::BIGINT) AS peak_ms, count(*) AS n_steps, sum(length(props))::BIGINT AS n_rows,
        count(DISTINCT event_type) AS n_partitions, max(value) AS skew_pct
    FROM events"""

ORACLE: dict[str, str] = {
    "vector_file_scan": f"""SELECT row_number() OVER (ORDER BY vec_id) - 1 AS pos, vec_id::INT AS token,
        {as_text(DOUBLES)} AS embedding FROM embeddings""",
    "vector_line_parse": f"""SELECT vec_id::INT AS token, unnest(range(len(embedding)))::INT AS j,
        unnest(list_transform({DOUBLES}, lambda x: round(x, 6))) AS x FROM embeddings""",
    "vector_line_counts": f"""
        SELECT source, sum(good::INT)::BIGINT AS n_good, sum((NOT good)::INT)::BIGINT AS n_bad FROM (
            SELECT source, coalesce({GOOD_LINE}, false) AS good FROM (
                SELECT 'embeddings' AS source,
                    vec_id || chr(9) || '[' || array_to_string(embedding, ',') || ']' AS line FROM embeddings
                UNION ALL SELECT 'event values', event_id || chr(9) || value FROM events
                UNION ALL SELECT 'event texts', event_id || chr(9) || props FROM events
                UNION ALL SELECT 'documents', text FROM documents)
        ) GROUP BY source""",
    "report_file": f"SELECT line FROM ({REPORT})",
    "vector_width": "SELECT coalesce((SELECT len(embedding) FROM embeddings ORDER BY vec_id LIMIT 1), 0)::INT AS width",
    "vector_table_check": f"""
        SELECT source, count(*) AS n_vectors, min(w)::INT AS min_width, max(w)::INT AS max_width,
            min(w) = max(w) AS valid
        FROM (SELECT 'embeddings' AS source, len(embedding) AS w FROM embeddings
            UNION ALL SELECT 'documents', len({WORDS}) FROM documents) GROUP BY source""",
    "width_violations": f"""
        SELECT count(*) AS n_examples, sum((len(f) <> 128)::INT)::BIGINT AS bad_features,
            sum((len(list_distinct(f)) <> 16)::INT)::BIGINT AS bad_labels
        FROM (SELECT {LENGTHS} AS f FROM documents)""",
    "document_windows": f"SELECT doc_id, start, {JOINED} FROM ({DOCUMENT_WINDOWS})",
    "document_windows_by_row": f"SELECT doc_id, start, {JOINED} FROM ({DOCUMENT_WINDOWS})",
    "conversation_windows": f"""
        SELECT conv_id, start, {JOINED} FROM ({row_windows(
            f"(SELECT conv_id, turn, unnest(range(len({WORDS}))) AS i, unnest({WORDS}) AS token FROM conversations)",
            8, "token", "turn, i", "conv_id")})""",
    "embedding_windows": f"""
        SELECT start, {JOINED} FROM ({row_windows(
            "(SELECT vec_id, vec_id::VARCHAR AS token FROM embeddings)", 4, "token", "vec_id")})""",
    "event_windows": f"SELECT start, {JOINED} FROM ({row_windows('events', 8, 'event_type', 'event_id')})",
    "last_vectors": f"""
        SELECT label, {as_text("e")} AS embedding
        FROM (SELECT label, arg_max({DOUBLES}, vec_id) AS e FROM embeddings GROUP BY label)""",
    "last_values": f"""
        SELECT token, {as_text("[v]")} AS embedding
        FROM (SELECT user_id AS token, arg_max(value, event_id) AS v FROM events GROUP BY user_id)""",
    "attach_vectors": ATTACHED,
    "attach_vectors_shuffled": ATTACHED,
    "hash_vectors": f"""
        SELECT token, {as_text(made_vector("token"))} AS embedding FROM (SELECT DISTINCT token FROM {TOKENS})""",
    "position_codes": codes_of(2),
    "position_codes_published": codes_of(1),
    "coded_vectors": f"SELECT vec_id, {as_text(add(DOUBLES, position_code('vec_id')))} AS coded FROM embeddings",
    "embedding_features": f"""
        SELECT start, unnest(range(len(features)))::INT AS j,
            unnest(list_transform(features, lambda x: round(x, 6))) AS x FROM ({EMBEDDING_EXAMPLES})""",
    "embedding_examples": f"""
        SELECT start, {as_text("features")} AS features, {as_text("label")} AS label
        FROM ({EMBEDDING_EXAMPLES})""",
    "document_examples": DOCUMENT_EXAMPLES,
    "document_examples_by_expression": DOCUMENT_EXAMPLES,
    "document_examples_by_index": DOCUMENT_EXAMPLES,
    "token_numbers": f"""
        SELECT token, (row_number() OVER (ORDER BY token) - 1)::INT AS no FROM (SELECT DISTINCT unnest({WORDS}) AS token FROM documents)""",
    "document_index_blocks": f"""
        WITH t AS (SELECT doc_id, unnest({WORDS}) AS token, unnest(range(len({WORDS}))) AS pos FROM documents),
        numbers AS (SELECT token, row_number() OVER (ORDER BY token) - 1 AS no FROM (SELECT DISTINCT token FROM t)),
        lent AS (
            SELECT doc_id, pos, token, b * 2048 AS block_start FROM (
                SELECT *, unnest(CASE WHEN pos >= 2048 AND pos % 2048 < 4 THEN [pos // 2048 - 1, pos // 2048] ELSE [pos // 2048] END) AS b
                FROM t)
        )
        SELECT doc_id, block_start, md5(string_agg(no::VARCHAR, ',' ORDER BY pos)) AS items, count(*)::INT AS n_items
        FROM lent JOIN numbers USING (token) GROUP BY doc_id, block_start""",
    "fit_features": f"SELECT doc_id, {as_text(fit(LENGTHS, 128))} AS features FROM documents",
    "fit_labels": f"""
        SELECT doc_id, 64 AS width, {as_text(fit("d", 64))} AS label FROM (
            SELECT doc_id, list_transform(list_filter(list_zip(t, range(len(t))),
                lambda p: list_position(t, p[1]) = p[2] + 1), lambda p: p[1]) AS d
            FROM (SELECT doc_id, {LENGTHS} AS t FROM documents))""",
    "split_documents": f"""
        SELECT doc_id, {split_index("doc_id", (0.8,), 42)} AS split,
            {split_index("doc_id", (0.5, 0.8), 7)} AS split_of_three FROM documents""",
    "capped_sample": "SELECT event_id, user_id, event_type FROM events ORDER BY ts, event_id LIMIT 1000",
    "rows_per_partition": f"""
        WITH n AS (SELECT greatest(1, -(-count(*) // 1000)) AS n FROM events),
        placed AS (SELECT floor({unit("'3:' || event_id")} * (SELECT n FROM n))::INT AS place FROM events)
        SELECT b::INT AS partition, count(place) AS cnt
        FROM (SELECT unnest(range((SELECT n FROM n))) AS b) LEFT JOIN placed ON place = b GROUP BY b""",
    "rows_per_bucket": """
        SELECT b::INT AS partition, count(d.bucket) AS cnt FROM range(32) r(b)
        LEFT JOIN (SELECT replace(source, 'src', '')::INT AS bucket FROM documents) d ON d.bucket = b
        GROUP BY b""",
    "bucket_skew": """
        WITH counts AS (
            SELECT b, count(d.bucket) AS cnt FROM range(32) r(b)
            LEFT JOIN (SELECT replace(source, 'src', '')::INT AS bucket FROM documents) d ON d.bucket = b
            GROUP BY b)
        SELECT count(*) AS n_partitions, sum(cnt)::BIGINT AS n_rows,
            round(max(abs(cnt - mean) / mean * 100), 6) AS skew_pct
        FROM counts, (SELECT avg(cnt) AS mean FROM counts)""",
    "split_counts": f"""
        SELECT {split_index("doc_id || ':' || start", (0.8,), 42)} AS split, count(*) AS n_rows
        FROM ({DOCUMENT_WINDOWS}) GROUP BY 1""",
    "pair_loss": f"""
        SELECT round(avg(list_avg(list_transform(list_zip(pred, label),
            lambda p: (p[1] - p[2]) * (p[1] - p[2])))), 6) AS loss FROM ({PAIRS})""",
    "pair_cosine": f"SELECT start, round({COSINE}, 6) AS cosine FROM ({PAIRS})",
    "pair_hit_rate": f"""
        SELECT round(100 * avg((c > 0.5)::INT::DOUBLE), 6) AS accuracy,
            round(100 * avg((c > 0.1)::INT::DOUBLE), 6) AS accuracy_low
        FROM (SELECT {COSINE} AS c FROM ({PAIRS}))""",
    "vector_stats": f"""
        SELECT label, {STAT_COLUMNS}, round(stddev_pop(x), 6) AS std
        FROM (SELECT label, unnest({DOUBLES}) AS x FROM embeddings) GROUP BY label""",
    "vector_stats_sample": f"""
        SELECT {STAT_COLUMNS}, round(stddev_samp(x), 6) AS std
        FROM (SELECT unnest({LENGTHS}) AS x FROM documents)""",
    "total_duration": """
        SELECT event_type, (epoch_us(max(ts)) - epoch_us(min(ts))) // 1000 AS total_ms FROM events GROUP BY event_type""",
    "mean_batch_time": """
        SELECT event_type, count(*) AS n_steps, sum(length(props))::BIGINT AS n_rows,
            round(sum(round(value * 100)::BIGINT)::DOUBLE / count(*), 6) AS ms_per_step,
            round(sum(round(value * 100)::BIGINT)::DOUBLE / sum(length(props)), 6) AS ms_per_row
        FROM events GROUP BY event_type""",
    "peaks": """
        SELECT event_type, max(round(value * 100)::BIGINT) AS peak_ms, max(length(props))::BIGINT AS peak_rows
        FROM events GROUP BY event_type""",
    "nested_peaks": f"""
        SELECT lang, max(list_max(list_transform({WORDS}, lambda t: length(t))))::INT AS peak_rows
        FROM documents GROUP BY lang""",
    "report_lines": REPORT,
    "log_lines": f"""
        SELECT epoch, 'Epoch ' || epoch || ' Summary; Training Loss: ' || {fixed('loss', 6)}
            || '; Training Accuracy: ' || {fixed('accuracy', 2, '%%')}
            || '; Validation Loss: ' || CASE WHEN val_loss IS NULL THEN 'N/A' ELSE {fixed('val_loss', 6)} END
            || '; Validation Accuracy: '
            || CASE WHEN val_accuracy IS NULL THEN 'N/A' ELSE {fixed('val_accuracy', 2, '%%')} END
            || '; Learning Rate: ' || {fixed('learning_rate', 6)}
            || '; Duration: ' || ms || 'ms' AS line
        FROM ({DAY_EPOCHS})""",
    "gradient_log_lines": f"""
        SELECT epoch, 'Epoch ' || epoch || ' Gradient Statistics; Norm: ' || {fixed('norm', 6)} || '; Min: '
            || {fixed('low', 6)} || '; Max: ' || {fixed('high', 6)} || '; Mean: ' || {fixed('mean', 6)}
            || '; Std Dev: ' || {fixed('std', 6)} AS line
        FROM (
            SELECT day(ts)::INT AS epoch, sqrt(sum(value * value)) AS norm, min(value) AS low, max(value) AS high,
                avg(value) AS mean, stddev_pop(value) AS std FROM events GROUP BY 1)""",
    "run_report": f"""
        WITH run AS ({EVENT_RUN}),
        lines AS (
            SELECT unnest([
                '=== Training Metrics Report ===', 'Generated: 2024-11-03_00-08-04', '',
                '=== Training Summary ===', 'Total Duration: ' || {duration('total_ms')}, 'Total Epochs: ' || n_epochs,
                'Final Training Accuracy: ' || {fixed('accuracy', 2, '%%')}, NULL, 'Final Loss: ' || {fixed('loss', 6)}, NULL,
                'Average Batch Time: ' || {fixed('ms_per_step', 2)} || ' ms',
                'Average Row Time: ' || {fixed('ms_per_row', 2)} || ' ms',
                'Peak Batch Time: ' || {fixed('peak_ms::DOUBLE', 2)} || ' ms', '',
                '=== Model Statistics ===', 'Total Parameters: ' || n_rows, 'Layer Sizes: 8 → 4',
                'Total Batches Processed: ' || n_steps,
                'Average Processing Time per Batch: ' || {fixed('ms_per_step', 2)} || ' ms',
                'Total Rows Processed: ' || n_rows, '',
                '=== Spark Execution Statistics ===', 'Data Partitions: ' || n_partitions,
                'Data Partition Skew: ' || {fixed('skew_pct', 2, '%%')}, '', '=== Epoch Details ==='
            ]) AS line, unnest(range(26))::INT AS n FROM run)
        SELECT 0 AS section, 0 AS item, n, line FROM lines WHERE line IS NOT NULL
        UNION ALL SELECT 1 AS section, item, n, line FROM ({REPORT})""",
    "run_log_lines": f"""
        SELECT 'Training Complete; Total Duration: ' || total_ms || 'ms; Average Batch Time: ' || {fixed('ms_per_step', 2)}
            || 'ms; Peak Batch Time: ' || peak_ms || 'ms; Total Parameters: ' || n_rows || '; Batches Processed: '
            || n_steps || '; Partition Skew: ' || {fixed('skew_pct', 2, '%%')} AS line
        FROM ({EVENT_RUN})""",
    "batch_log_lines": f"""
        SELECT epoch, worker, 'Epoch ' || epoch || ', worker ' || worker || '; Steps: ' || steps || '; Rows: ' || rows
            || '; Loss: ' || {fixed('loss', 6)} || '; Time: ' || ms || 'ms' AS line
        FROM (
            SELECT day(ts)::INT AS epoch, user_id AS worker, count(*) AS steps, sum(length(props))::BIGINT AS rows,
                avg(value) AS loss, sum(round(value * 100)::BIGINT)::BIGINT AS ms FROM events GROUP BY 1, 2)""",
    "duration_texts": f"""
        SELECT event_id, {duration("ms")} AS duration
        FROM (SELECT event_id, (epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-01')) // 1000 AS ms FROM events)""",
    "model_round_trip": f"SELECT start, {as_text('pred')} AS pred FROM ({MADE_PREDICTIONS})",
    "scored_predictions": f"SELECT start, {as_text('pred')} AS pred FROM ({MADE_PREDICTIONS})",
    "evaluated_splits": f"""
        SELECT split, count(*) AS n_rows, round(avg(e), 6) AS loss,
            round(100 * avg((c > 0.1)::INT::DOUBLE), 6) AS accuracy
        FROM (SELECT {split_index("start", (0.8,), 42)} AS split, {COSINE} AS c,
                list_avg(list_transform(list_zip(pred, label), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS e
            FROM ({MADE_PREDICTIONS})) GROUP BY split""",
    "event_positions_by_time": "SELECT event_id, row_number() OVER (ORDER BY ts, event_id) - 1 AS pos FROM events",
    "event_totals_by_type": """
        SELECT event_id, coalesce(sum(length(props)) OVER (
            PARTITION BY user_id ORDER BY event_type, value, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING
        ), 0)::BIGINT AS before FROM events""",
    "trained_parameters": f"""
        WITH {ONE_STEP}
        SELECT layer::INT AS layer, kind, place::INT AS place, round(x, 6) AS x FROM stepped""",
    "trained_batches": f"""
        WITH {ONE_STEP}
        SELECT 1 AS epoch, 0 AS round, worker, 1::BIGINT AS steps, n AS rows, 0.001::DOUBLE AS learning_rate,
            round(loss, 6) AS loss, round(accuracy, 6) AS accuracy, round(norm, 6) AS norm, round(mean, 6) AS mean,
            round(std, 6) AS std
        FROM (SELECT worker, count(*) AS n, avg(loss) AS loss, 100 * avg(hit::INT::DOUBLE) AS accuracy FROM backward GROUP BY 1)
        JOIN (SELECT worker, sqrt(sum(g * g)) AS norm, avg(g) AS mean, stddev_pop(g) AS std FROM gradients GROUP BY 1)
            USING (worker)""",
    "trained_epochs": f"""
        WITH {ONE_STEP}, {STEPPED_PREDICTIONS}
        SELECT 1 AS epoch, round(avg(e) FILTER (split = 0), 6) AS loss,
            round(100 * avg(hit::INT::DOUBLE) FILTER (split = 0), 6) AS accuracy,
            round(avg(e) FILTER (split = 1), 6) AS val_loss,
            round(100 * avg(hit::INT::DOUBLE) FILTER (split = 1), 6) AS val_accuracy,
            0.001::DOUBLE AS learning_rate
        FROM judged""",
    "trained_rows": f"""
        SELECT epoch::INT AS epoch, count(*) AS n_rows
        FROM (SELECT {split_index("doc_id || ':' || start", (0.8,), 42)} AS split FROM ({DOCUMENT_WINDOWS})),
            range(1, 3) e(epoch)
        WHERE split = 0 GROUP BY epoch""",
    "model_statistics": """
        WITH w AS (SELECT max(len(embedding)) AS d FROM embeddings)
        SELECT (4 * d * 128 + 128 + 128 * 128 + 128 + 128 * d + d)::BIGINT AS n_parameters,
            (4 * d) || ',128,128,' || d AS layer_sizes FROM w""",
}
