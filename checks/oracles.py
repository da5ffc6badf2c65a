"""The SQL each query must equal, over the same tables."""

from __future__ import annotations

from checks.names import CAPTIONS, COLUMNS, FLAGS
from checks.tables import DIRTY, RAW, catalogue_sql, gapped_sql, producer_sql
from shelfmark.functions.stop_words import ENGLISH

_NUMBERS = ("id", "eclassnumber")
_TEXTS = ("description", "category")


_ORDERED = ", ".join(COLUMNS)


def _with(source: str, body: str) -> str:
    return f"WITH eclasses AS ({source}) {body}".replace(") ,", "),")


_CLEAN = catalogue_sql()
_GAPPED = gapped_sql()


def _decoded(source: str) -> str:
    def value(name: str) -> str:
        if name in _TEXTS:
            return name
        return f"coalesce({name}, {'0' if name in _NUMBERS else 'false'}) AS {name}"

    return f"SELECT {', '.join(map(value, COLUMNS))} FROM ({source})"


def _line(columns=COLUMNS) -> str:
    return " || ',' || ".join(f"coalesce(CAST({name} AS VARCHAR), 'null')" for name in columns)


def _quoted_line() -> str:
    """Fields that hold a comma, a quote or a line break are quoted, quotes inside doubled."""

    def field(name: str) -> str:
        if name not in _TEXTS:
            return f"CAST({name} AS VARCHAR)"
        doubled = f"""'"' || replace({name}, '"', '""') || '"'"""
        return f"CASE WHEN regexp_matches({name}, '[,\"\r\n]') THEN {doubled} ELSE {name} END"

    return " || ',' || ".join(map(field, COLUMNS))


def _trimmed(value: str) -> str:
    return rf"regexp_replace(regexp_replace({value}, '^[\x00-\x20]+', ''), '[\x00-\x20]+$', '')"


def _rendered() -> str:
    return " || ".join(
        f"'{caption}' || coalesce(CAST({name} AS VARCHAR), 'null')"
        for caption, name in zip(CAPTIONS, COLUMNS, strict=True)
    )


def _parsed(source: str) -> str:
    """Split lines at commas and read each field, a bad one as NULL."""

    def field(i: int, name: str) -> str:
        part = f"f[{i}]"
        if name in _NUMBERS:
            read = f"CASE WHEN regexp_full_match({part}, '[+-]?[0-9]+') THEN try_cast({part} AS INT) END"
        elif name in _TEXTS:
            read = f"nullif({part}, '')"
        else:
            read = f"CASE lower({part}) WHEN 'true' THEN true WHEN 'false' THEN false END"
        return f"{read} AS {name}"

    fields = ", ".join(field(i, name) for i, name in enumerate(COLUMNS, 1))
    return f"SELECT {fields} FROM (SELECT string_split({_line()}, ',') AS f FROM ({source}))"


# The stage's own default, which the top-k queries ask for.
VOCABULARY_SIZE = 262_144

_BLANK = r"[ \t\n\x0B\f\r]"
_WORDS = ", ".join("('" + word.replace("'", "''") + "')" for word in ENGLISH)


def _text_ctes(column: str, n: int) -> str:
    """Tokens (t), kept tokens (k), n-grams (g), counts per row (tf), per term (st), rows (m)."""
    leads = "".join(f" || ' ' || lead(w, {k}) OVER x" for k in range(1, n))
    return rf"""WITH eclasses AS ({_CLEAN}),
sw(w) AS (VALUES {_WORDS}),
d AS (SELECT id, lower({column}) AS low, regexp_replace(lower({column}), '{_BLANK}+$', '') AS body
      FROM eclasses),
s AS (SELECT id, CASE WHEN low <> '' AND body = '' THEN CAST([] AS VARCHAR[])
                      ELSE string_split_regex(body, '{_BLANK}') END AS raw FROM d),
t AS (SELECT id, unnest(raw) AS w, unnest(range(len(raw))) AS pos FROM s),
k AS (SELECT id, w, row_number() OVER (PARTITION BY id ORDER BY pos) - 1 AS pos FROM t
      WHERE w NOT IN (SELECT w FROM sw)),
g AS (SELECT id, pos, term FROM (
        SELECT id, pos, w{leads} AS term, lead(pos, {n - 1}) OVER x AS last
        FROM k WINDOW x AS (PARTITION BY id ORDER BY pos)) WHERE last IS NOT NULL),
tf AS (SELECT id, term, count(*) AS tf FROM g GROUP BY ALL),
st AS (SELECT term, CAST(sum(tf) AS BIGINT) AS cf, count(*) AS df FROM tf GROUP BY term),
m AS (SELECT count(*) AS rows FROM eclasses),
v AS (SELECT term, cf, df, row_number() OVER (ORDER BY cf DESC, md5(term), term) - 1 AS rank
      FROM st QUALIFY rank < {VOCABULARY_SIZE})"""


def _text(column: str, n: int, body: str) -> str:
    return f"{_text_ctes(column, n)} {body}"


_WEIGHT = "tf * ln((rows + 1.0) / (df + 1.0))"


def _tfidf(facts: str) -> str:
    return (
        f"SELECT id, term, tf, df, round({_WEIGHT}, 6) AS tfidf FROM tf JOIN {facts} USING (term), m"
    )


def _feature_slots(buckets: dict[str, int] | None = None, by_term: bool = False) -> str:
    """Long form of the assembled vector: scalars, description weights, category weights.

    With `buckets` a term stands for the first 32 bits of its MD5, modulo the column's number; a bucket has one
    weight, or the sum of its terms' own if `by_term`.
    """
    scalars = {"id": "id", "description_length": "length(description)", **{f: f for f in FLAGS}}
    parts = [
        f"SELECT id, '{name}' AS part, CAST(NULL AS VARCHAR) AS term, CAST({value} AS DOUBLE) AS value"
        " FROM eclasses"
        for name, value in scalars.items()
    ]

    def weights(column: str, n: int) -> str:
        body = f"SELECT id, '{column}' AS part, term, {_WEIGHT} AS value FROM tf JOIN v USING (term), m"
        if by_term:
            hashed = f"CAST(CAST(('0x' || substr(md5(term), 1, 8)) AS BIGINT) % {buckets[column]} AS VARCHAR)"
            body = f"""SELECT id, '{column}' AS part, {hashed} AS term, sum({_WEIGHT}) AS value
FROM tf JOIN st USING (term), m GROUP BY ALL"""
        elif buckets:
            hashed = f"CAST(CAST(('0x' || substr(md5(term), 1, 8)) AS BIGINT) % {buckets[column]} AS VARCHAR)"
            body = f"""SELECT id, '{column}' AS part, term, {_WEIGHT} AS value
FROM (SELECT id, {hashed} AS term, CAST(sum(tf) AS BIGINT) AS tf FROM tf GROUP BY ALL)
JOIN (SELECT {hashed} AS term, count(DISTINCT id) AS df FROM tf GROUP BY ALL) USING (term), m"""
        return f"SELECT * FROM ({_text(column, n, body)})"

    parts += [weights("description", 5), weights("category", 1)]
    union = " UNION ALL ".join(parts)
    return _with(
        _CLEAN,
        f"SELECT id, part, term, round(value, 6) AS value FROM ({union}) WHERE value <> 0",
    )


def _bucket(key: str, salt: str, buckets: int) -> str:
    digest = f"md5(CAST({key} AS VARCHAR) || ':{salt}')"
    return f"CAST(('0x' || substr({digest}, 1, 8)) AS BIGINT) % {buckets}"


_SPLIT = f"""SELECT id, eclassnumber,
  CASE WHEN {_bucket('id', '123', 10)} < 7 THEN 'train' ELSE 'test' END AS split,
  CAST({_bucket('id', 'fold', 5)} AS INT) AS fold FROM eclasses"""

_STATISTICS = """count(eclassnumber) AS count, round(avg(eclassnumber), 6) AS mean,
  round(stddev_samp(eclassnumber), 6) AS stddev,
  min(eclassnumber) AS min, max(eclassnumber) AS max"""

_SURROGATE = """SELECT l_extendedprice AS eclassnumber, l_quantity * 2000 AS prediction, l_returnflag
  FROM lineitem"""

_ERRORS = """round(avg(abs(eclassnumber - prediction)), 4) AS mae,
  round(avg((eclassnumber - prediction) ** 2), 4) AS mse,
  round(sqrt(avg((eclassnumber - prediction) ** 2)), 4) AS rmse,
  round(1 - sum((eclassnumber - prediction) ** 2) / (var_pop(eclassnumber) * count(*)), 4) AS r2,
  count(*) AS n_used, CAST(0 AS BIGINT) AS n_left_out"""

_RESULT = f"""SELECT eclassnumber, CAST(trunc(prediction) AS INT) AS prediction FROM ({_SURROGATE})"""

_INSERTED = ", ".join(
    {
        "id": "CAST(s_suppkey + 1000000 AS INT) AS id",
        "description": "s_name AS description",
        "category": "CAST(NULL AS VARCHAR) AS category",
        "brand": "s_acctbal > 0 AS brand",
        "eclassnumber": "CAST(s_nationkey AS INT) AS eclassnumber",
    }.get(name, f"CAST(NULL AS BOOLEAN) AS {name}")
    for name in COLUMNS
)

_HIT = "eclassnumber >= 2000000 AND category IS NOT NULL"
_UPDATED = ", ".join(
    f"CASE WHEN {_HIT} THEN {value} ELSE {name} END AS {name}"
    if (value := {"category": "category || '!'", "taric": "details", "details": "taric"}.get(name))
    else name
    for name in COLUMNS
)

_COMMAND = """CASE id % 4
  WHEN 0 THEN 'SELECT * FROM eclasses WHERE description = '''
  WHEN 1 THEN 'Select Count(*) from eclasses where description = '''
  WHEN 2 THEN 'UPDATE eclasses SET description = '''
  ELSE 'DELETE FROM eclasses WHERE description = ''' END || description || ''''"""


def _command_sql() -> dict[str, str]:
    """Each command's next snapshot, and the report after all of them."""
    inserted = ", ".join(
        {
            "id": "CAST(id + 1000000 AS INT) AS id",
            "description": "upper(category) AS description",
            "brand": "NOT brand AS brand",
            "eclassnumber": "eclassnumber",
            "category": "CAST(NULL AS VARCHAR) AS category",
        }.get(name, f"CAST(NULL AS BOOLEAN) AS {name}")
        for name in COLUMNS
    )

    def insert(t):
        return f"SELECT * FROM {t} UNION ALL SELECT {inserted} FROM {t} WHERE link"

    def update(t):
        return f"SELECT {_UPDATED} FROM {t}"

    def delete(t):
        even = f"SELECT category FROM {t} GROUP BY category HAVING count(*) % 2 = 0"
        return f"SELECT * FROM {t} WHERE (category IN ({even}) OR eclassnumber IS NULL) IS NOT TRUE"

    report = "SELECT category, brand, count(*) AS n, min(id) AS least FROM c GROUP BY category, brand"
    return {
        "command_insert": _with(_GAPPED, insert("eclasses")),
        "command_update": _with(_GAPPED, update("eclasses")),
        "command_delete": _with(_GAPPED, delete("eclasses")),
        "command_session": _with(_GAPPED, f", a AS ({insert('eclasses')}), b AS ({update('a')}), c AS ({delete('b')}) {report}"),
    }


def _replaced(name: str, value: str) -> str:
    return ", ".join(f"{value} AS {c}" if c == name else c for c in COLUMNS)


_CHANGED = f"""SELECT {_replaced('category', 'CASE WHEN id % 10 = 4 THEN upper(category) ELSE category END')}
  FROM eclasses WHERE (id % 10 = 3) IS NOT TRUE"""
_NEXT = f"""{_CHANGED} UNION ALL SELECT * FROM eclasses WHERE id % 10 = 5
  UNION ALL SELECT {_replaced('id', 'CAST(id + 1000000 AS INT)')} FROM eclasses WHERE id % 10 = 6"""

# Equal rows are counted on each side; a key that both lost and won rows was updated.
_CHANGES = f""", later AS ({_NEXT}), counted AS (
  SELECT {_ORDERED}, sum(s) AS moved FROM (SELECT *, -1 AS s FROM eclasses UNION ALL SELECT *, 1 AS s FROM later)
  GROUP BY {_ORDERED} HAVING sum(s) <> 0
), torn AS (SELECT id FROM counted WHERE id IS NOT NULL GROUP BY id HAVING min(moved) < 0 AND max(moved) > 0)
SELECT {_ORDERED}, CAST(abs(moved) AS BIGINT) AS copies,
  CASE WHEN id IN (SELECT id FROM torn) THEN CASE WHEN moved > 0 THEN 'update_after' ELSE 'update_before' END
    WHEN moved > 0 THEN 'insert' ELSE 'delete' END AS change FROM counted"""


def _repair_reasons() -> str:
    """Why each line of a dump with line breaks in it cannot be read from both ends."""
    whole = r"regexp_full_match({0}, '[+-]?[0-9]{{1,10}}') AND try_cast({0} AS INT) IS NOT NULL OR {0} IN ('', 'null')"
    return rf"""WITH lines AS (
  SELECT unnest(string_split_regex({_line()}, '\r\n|\r|\n')) AS value FROM ({catalogue_sql(RAW)})
), parted AS (SELECT value, string_split(value, ',') AS f FROM lines)
SELECT CASE WHEN len(f) < 14 THEN 'fields' WHEN NOT ({whole.format('f[1]')}) THEN 'id'
    WHEN len(list_filter(f[len(f) - 10 : len(f) - 1], lambda x: lower(x) NOT IN ('true', 'false', '', 'null'))) > 0 THEN 'flags'
    WHEN NOT ({whole.format('f[len(f)]')}) THEN 'label' END AS reason,
  count(*) AS n, count(DISTINCT value) AS n_values
FROM parted GROUP BY ALL"""


def _shifted(delta: int) -> str:
    columns = ", ".join(
        f"eclassnumber + {delta} AS eclassnumber" if name == "eclassnumber" else name
        for name in COLUMNS
    )
    return f"SELECT {columns} FROM eclasses"


_OLS = """SELECT round(regr_slope(y, x), 6) AS slope, round(regr_intercept(y, x), 6) AS intercept
FROM (SELECT l_extendedprice AS y, l_quantity AS x FROM lineitem)"""

_ENET = """WITH d AS (SELECT l_extendedprice * l_quantity AS y, l_quantity AS x FROM lineitem),
a AS (SELECT corr(y, x) AS r, stddev_pop(y) AS sy, stddev_pop(x) AS sx, avg(y) AS my, avg(x) AS mx
      FROM d),
b AS (SELECT sign(r) * greatest(abs(r) - 5000 / sy * 0.5, 0) / (1 + 5000 / sy * 0.5) * sy / sx AS k,
             my, mx FROM a)
SELECT round(k, 4) AS slope, round(my - k * mx, 4) AS intercept FROM b"""


def _penalised(fold: str) -> str:
    """Closed-form slope of the elastic net with one feature, from moments r, sy, sx."""
    return f"""SELECT {fold} penalty, my, mx,
  sign(r) * greatest(abs(r) - penalty / sy * 0.5, 0) / (1 + penalty / sy * 0.5) * sy / sx AS slope"""


_MOMENTS = """corr(y, x) AS r, stddev_pop(y) AS sy, stddev_pop(x) AS sx,
  avg(y) AS my, avg(x) AS mx"""

_LINE = f"""WITH d AS (SELECT id, x, y, {_bucket('id', '123', 10)} < 7 AS train,
  {_bucket('id', 'fold', 5)} AS fold FROM (
    SELECT concat(l_orderkey, '-', l_linenumber) AS id, l_quantity AS x, l_extendedprice AS y
    FROM lineitem)),
p(penalty) AS (VALUES (0.0::DOUBLE), (1000.0::DOUBLE), (5000.0::DOUBLE)),
f AS (SELECT DISTINCT fold FROM d),
s AS (SELECT f.fold, {_MOMENTS} FROM f JOIN d ON train AND d.fold <> f.fold GROUP BY f.fold),
k AS ({_penalised('fold,')} FROM s, p),
e AS (SELECT penalty, sqrt(avg((y - my - slope * (x - mx)) ** 2)) AS rmse
      FROM k JOIN d ON train AND d.fold = k.fold GROUP BY penalty, k.fold),
c AS (SELECT penalty, avg(rmse) AS rmse FROM e GROUP BY penalty)"""

_CV_LINE = f"{_LINE} SELECT penalty, round(rmse, 4) AS rmse FROM c"

_PREDICTED_LINE = f"""{_LINE},
w AS (SELECT {_MOMENTS} FROM d WHERE train),
b AS (SELECT penalty FROM c ORDER BY rmse, penalty LIMIT 1),
m AS ({_penalised('')} FROM w, b)
SELECT id, y AS eclassnumber, round(my + slope * (x - mx), 4) AS prediction
FROM d, m WHERE NOT train"""


# The scalar slots in order, and the label as last of thirteen columns.
_SLOTS = ["id_slot", "description_length", *FLAGS]
_P = len(_SLOTS)
_SWEEPS = 400


def _matrix(value) -> str:
    size = range(1, _P + 2)
    return "[" + ", ".join("[" + ", ".join(value(i, j) for j in size) + "]" for i in size) + "]"


# Moments of the train rows without each fold (and of all, as fold -1); then, from zero, sweep after sweep
# over the slots: each takes what its correlation with the rest leaves, less the penalty.
_SCALARS = f"""WITH RECURSIVE eclasses AS ({_CLEAN}),
d AS (SELECT id, split, fold, CAST(eclassnumber AS DOUBLE) AS y,
  [CAST(id AS DOUBLE), CAST(length(description) AS DOUBLE), {', '.join(f'CAST(e.{f} AS DOUBLE)' for f in FLAGS)}, CAST(eclassnumber AS DOUBLE)] AS z
  FROM ({_SPLIT}) JOIN eclasses e USING (id, eclassnumber)),
f AS (SELECT DISTINCT fold AS held FROM d UNION ALL SELECT -1),
s AS (SELECT held, [{', '.join(f'avg(z[{i}])' for i in range(1, _P + 2))}] AS m,
  {_matrix(lambda i, j: f'covar_pop(z[{i}], z[{j}])')} AS c
  FROM f JOIN d ON split = 'train' AND fold <> held GROUP BY held),
p(penalty) AS (VALUES (0.0::DOUBLE), (1000.0::DOUBLE), (100000.0::DOUBLE)),
k AS (SELECT held, penalty, m, list_transform(range(1, {_P + 2}), lambda i: sqrt(c[i][i])) AS sd,
  list_transform(range(1, {_P + 1}), lambda i: list_transform(range(1, {_P + 1}), lambda j: c[i][j] / sqrt(c[i][i] * c[j][j]))) AS r,
  list_transform(range(1, {_P + 1}), lambda i: c[i][{_P + 1}] / sqrt(c[i][i] * c[{_P + 1}][{_P + 1}])) AS t,
  penalty / sqrt(c[{_P + 1}][{_P + 1}]) * 0.5 AS soft FROM s, p),
steps AS (
  SELECT held, penalty, 0 AS step, list_transform(range({_P}), lambda i: CAST(0 AS DOUBLE)) AS b FROM k
  UNION ALL
  SELECT held, penalty, step + 1, list_transform(b, lambda v, i: CASE WHEN i = step % {_P} + 1 THEN
    sign(t[i] - list_dot_product(r[i], b) + v) * greatest(abs(t[i] - list_dot_product(r[i], b) + v) - soft, 0) / (1 + soft) ELSE v END)
  FROM steps JOIN k USING (held, penalty) WHERE step < {_P * _SWEEPS}),
w AS (SELECT held, penalty, m, list_transform(b, lambda v, i: v * sd[{_P + 1}] / sd[i]) AS w
  FROM steps JOIN k USING (held, penalty) WHERE step = {_P * _SWEEPS}),
q AS (SELECT held, penalty, w, m[{_P + 1}] - list_dot_product(w, m[1:{_P}]) AS b0 FROM w),
e AS (SELECT penalty, held AS fold, sqrt(avg((y - b0 - list_dot_product(w, z[1:{_P}])) ** 2)) AS rmse
  FROM q JOIN d ON split = 'train' AND fold = held GROUP BY penalty, held)"""

_SCALAR_WEIGHTS = f"""{_SCALARS}
SELECT penalty, unnest([{', '.join(f"'{name}'" for name in _SLOTS)}, 'intercept']) AS slot,
  unnest(list_transform(list_append(w, b0), lambda v: round(v, 3))) AS weight FROM q WHERE held = -1"""
_SCALAR_PREDICTIONS = f"""{_SCALARS},
best AS (SELECT penalty FROM e GROUP BY penalty ORDER BY avg(rmse), penalty LIMIT 1)
SELECT id, CAST(y AS INT) AS eclassnumber, round(b0 + list_dot_product(w, z[1:{_P}]), 3) AS prediction
FROM d, q JOIN best USING (penalty) WHERE held = -1 AND split = 'test'"""


def _lines(source: str) -> str:
    return f"SELECT {_line()} AS value FROM ({source})"


ORACLES: dict[str, str] = {
    "full_scan": producer_sql(_CLEAN),
    "decode_nulls": _decoded(_GAPPED),
    "text_lines": f"""SELECT value, count(*) AS n FROM (
  SELECT unnest(string_split_regex({_line()}, '\\r\\n|\\r|\\n')) AS value
  FROM ({catalogue_sql(RAW)})) GROUP BY value""",
    "parquet_schema_scan": "SELECT "
    + ", ".join("CAST(NULL AS BOOLEAN) AS taric" if c == "taric" else c for c in COLUMNS)
    + f" FROM ({_CLEAN})",
    "read_batch": _with(_CLEAN, _shifted(1)),
    "stream_ingest": _CLEAN,
    "encode_lines": _lines(_GAPPED),
    "encode_csv_safe": f"SELECT {_quoted_line()} AS value FROM ({catalogue_sql(RAW)})",
    "csv_round_trip": catalogue_sql(RAW),
    "text_dump": "SELECT "
    + " || ',' || ".join(f"CAST({'NOT brand' if c == 'brand' else c} AS VARCHAR)" for c in COLUMNS)
    + f" AS value FROM ({_CLEAN})",
    "kafka_records": f"SELECT CAST(NULL AS VARCHAR) AS key, {_trimmed('value')} AS value"
    f" FROM ({_lines(_GAPPED)})",
    "publish_snapshot": f"SELECT CAST(NULL AS VARCHAR) AS key, {_trimmed('value')} AS value"
    f" FROM ({_lines(_decoded(_GAPPED))})",
    "render_rows": f"SELECT {_rendered()} AS line FROM ({_decoded(_GAPPED)})",
    "trim_lines": "SELECT CAST(doc_id AS BIGINT) AS id, "
    + _trimmed("' ' || chr(9) || chr(1) || text || chr(13) || chr(10) || ' ' || chr(31)")
    + " AS value FROM documents",
    "parse_lines": _CLEAN,
    "parse_lines_dirty": _parsed(catalogue_sql(DIRTY)),
    "parse_lines_repaired": f"SELECT * REPLACE (nullif(description, '') AS description) FROM ({catalogue_sql(DIRTY)})",
    "quarantine_counts": _repair_reasons(),
    "rename_columns": producer_sql(_GAPPED),
    "rename_to_consumer": _GAPPED,
    "description_length": "SELECT id, eclassnumber, CAST(length(description) AS INT)"
    f" AS description_length FROM ({_GAPPED})",
    "classify_commands": _with(
        _CLEAN,
        "SELECT id, contains(lower(command), 'select') AND NOT contains(lower(command), 'count')"
        f" AS returns_rows FROM (SELECT id, {_COMMAND} AS command FROM eclasses)",
    ),
    "feature_columns": _with(
        _CLEAN,
        "SELECT CAST(id AS DOUBLE) AS id, CAST(length(description) AS DOUBLE) AS description_length, "
        + ", ".join(f"CAST({name} AS DOUBLE) AS {name}" for name in FLAGS)
        + " FROM eclasses",
    ),
    "result_table_cast": "SELECT eclassnumber,"
    " CAST(trunc((eclassnumber - prediction) / 7) AS INT) AS prediction"
    f" FROM ({_SURROGATE})",
    "sql_select": f"SELECT * FROM ({producer_sql(_CLEAN)})"
    " WHERE brand AND category LIKE 'de%' OR eclassnumber < 2000000",
    "sql_count": _with(
        _CLEAN, "SELECT category, count(*) AS n FROM eclasses WHERE link GROUP BY category"
    ),
    "snapshot_insert": f"{_CLEAN} UNION ALL SELECT {_INSERTED} FROM supplier",
    "snapshot_update": f"SELECT {_UPDATED} FROM ({_GAPPED})",
    "snapshot_delete": f"SELECT * FROM ({_GAPPED}) WHERE (eclassnumber >= 2000000) IS NOT TRUE",
    **_command_sql(),
    "snapshot_changes": _with(_GAPPED, _CHANGES),
    "apply_changes": _with(_GAPPED, _NEXT),
    "undo_changes": _GAPPED,
    "change_records": f"""WITH eclasses AS ({_CLEAN}), later AS ({_CHANGED}), sent AS (
  SELECT CAST(id AS VARCHAR) AS key, {_line()} AS value FROM (SELECT * FROM later EXCEPT SELECT * FROM eclasses)
) SELECT key, {_trimmed('value')} AS value FROM sent
UNION ALL SELECT CAST(id AS VARCHAR), NULL FROM eclasses WHERE id % 10 = 3""",
    "stream_merged": f"""WITH eclasses AS ({_CLEAN}), later AS ({_CHANGED}) SELECT * FROM later
UNION ALL SELECT * FROM eclasses WHERE id % 10 = 3""",
    "stream_changes_merged": _with(_CLEAN, _CHANGED),
    "compacted_batches": _CLEAN,
    "latest_rows_gapped": f"""SELECT g.* REPLACE (category || ' v' || CAST(version AS VARCHAR) AS category), version
FROM ({_GAPPED}) g, (VALUES (1), (2)) v(version) WHERE id IS NULL OR version = 2""",
    "latest_snapshot": """SELECT user_id, event_id, event_type, value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""",
    "latest_whole_snapshot": "SELECT "
    + ", ".join("upper(category) AS category" if c == "category" else c for c in COLUMNS)
    + f" FROM ({_CLEAN}) WHERE link IS NOT TRUE",
    "tokenize": _text("description", 5, "SELECT id, CAST(pos AS INT) AS pos, w AS term FROM t"),
    "remove_stop_words": _text(
        "description", 5, "SELECT id, CAST(pos AS INT) AS pos, w AS term FROM k"
    ),
    "ngrams5": _text("description", 5, "SELECT id, CAST(pos AS INT) AS pos, term FROM g"),
    "term_counts": _text("description", 5, "SELECT id, term, tf FROM tf"),
    "vocabulary_topk": _text(
        "description", 5, "SELECT term, cf, df, CAST(rank AS INT) AS rank FROM v"
    ),
    "vocabulary_by_names": _text(
        "description", 5, "SELECT term, cf, df, CAST(rank AS INT) AS rank FROM v"
    ),
    "doc_freq": _text("description", 5, "SELECT term, df FROM st"),
    "tfidf": _text("description", 5, _tfidf("st")),
    "tfidf_limited": _text(
        "description",
        1,
        f"SELECT id, term, tf, df, CASE WHEN df >= 40 THEN round({_WEIGHT}, 6) ELSE 0 END AS tfidf"
        " FROM tf JOIN st USING (term), m WHERE tf >= 2 AND df >= 0.01 * rows",
    ),
    "tfidf_vocabulary": _text("description", 5, _tfidf("v")),
    "tokenize_category": _text(
        "category", 1, "SELECT id, CAST(pos AS INT) AS pos, w AS term FROM t"
    ),
    "category_stop": _text("category", 1, "SELECT id, CAST(pos AS INT) AS pos, w AS term FROM k"),
    "category_counts": _text("category", 1, "SELECT id, term, tf FROM tf"),
    "category_tfidf": _text("category", 1, _tfidf("v")),
    "feature_vectors": _feature_slots({"description": 131_072, "category": 4_096}),
    "feature_vectors_topk": _feature_slots(),
    "feature_vectors_weighted": _feature_slots({"description": 131_072, "category": 4_096}, by_term=True),
    "random_split": _with(
        _CLEAN, "SELECT id, eclassnumber, count(*) AS n FROM eclasses GROUP BY id, eclassnumber"
    ),
    "random_split_share": "SELECT true AS about_seventy_percent",
    "hash_split": _with(_CLEAN, f"SELECT id, split FROM ({_SPLIT})"),
    "hash_split_gapped": f"""SELECT CASE WHEN id IS NULL THEN 'rejected' ELSE split END AS split,
  CASE WHEN id IS NOT NULL THEN fold END AS fold, count(*) AS n
FROM ({_with(_GAPPED, _SPLIT)}) GROUP BY ALL""",
    "cv_fold_sizes": _with(
        _CLEAN,
        f"SELECT fold, count(*) AS n FROM ({_SPLIT}) WHERE split = 'train' GROUP BY fold",
    ),
    "linreg_ols_1d": _OLS,
    "linreg_enet_1d": _ENET,
    "linreg_scalars": _SCALAR_WEIGHTS,
    "cv_errors_scalars": f"{_SCALARS} SELECT penalty, fold, round(rmse, 3) AS rmse FROM e",
    "predictions_scalars": _SCALAR_PREDICTIONS,
    "metrics_scalars": f"SELECT {_ERRORS.replace(', 4)', ', 2)')} FROM ({_SCALAR_PREDICTIONS})",
    "exact_split": f"""WITH g AS ({_GAPPED}), k AS (
  SELECT id, row_number() OVER (ORDER BY md5(CAST(id AS VARCHAR) || ':exact:123')) AS place, count(*) OVER () AS n
  FROM (SELECT DISTINCT id FROM g WHERE id IS NOT NULL))
SELECT g.id, CASE WHEN g.id IS NULL THEN 'rejected' WHEN place <= k.n * 7 // 10 THEN 'train' ELSE 'test' END AS split, 2 * count(*) AS n
FROM g LEFT JOIN k USING (id) GROUP BY ALL""",
    "balanced_parts": f"""SELECT 'catalogue' AS name, count(*) AS n_rows, 1 AS most_met, 1 AS least_met,
  count(*) FILTER (id IS NULL) AS n_missing, CAST(8 AS BIGINT) AS n_parts, true AS balanced FROM ({_GAPPED})
UNION ALL SELECT 'lineitem', count(*), 1, 1, count(*) FILTER (l_orderkey IS NULL), 8, true FROM lineitem""",
    "chart_quantile_bins": f"""SELECT count(*) AS n, true AS within_share, CAST(8 AS BIGINT) AS strips,
  max(eclassnumber) AS greatest, CAST(min(prediction) AS DOUBLE) AS least FROM ({_RESULT})""",
    "cv_metrics_line": _CV_LINE,
    "predictions_line": _PREDICTED_LINE,
    "regression_metrics": f"SELECT {_ERRORS} FROM ({_SURROGATE})",
    "metrics_of_predictions": f"SELECT {_ERRORS} FROM ({_PREDICTED_LINE})",
    "report_of_predictions": f"""SELECT eclassnumber, CAST(trunc(prediction) AS INT) AS prediction
FROM ({_PREDICTED_LINE}) ORDER BY eclassnumber, prediction LIMIT 100""",
    "linreg_fit": f"""SELECT id, split, eclassnumber, CAST(0 AS DOUBLE) AS difference
FROM ({_with(_CLEAN, _SPLIT)})""",
    "regression_metrics_gapped": f"""SELECT * EXCLUDE (total) REPLACE (total - n_used AS n_left_out) FROM (
  SELECT {_ERRORS}, any_value(total) AS total
  FROM (SELECT eclassnumber, length(description) * 1000 AS prediction, count(*) OVER () AS total FROM ({_GAPPED}))
  WHERE eclassnumber IS NOT NULL AND prediction IS NOT NULL)""",
    "regression_metrics_by": f"SELECT l_returnflag, {_ERRORS} FROM ({_SURROGATE})"
    " GROUP BY l_returnflag",
    "describe_label": _with(_CLEAN, f"SELECT {_STATISTICS} FROM eclasses"),
    "describe_by_split": _with(
        _CLEAN,
        f"SELECT CASE WHEN grouping(split) = 1 THEN 'all' ELSE split END AS split, {_STATISTICS}"
        f" FROM ({_SPLIT}) GROUP BY ROLLUP (split)",
    ),
    "result_sorted": f"{_RESULT} ORDER BY eclassnumber, prediction",
    "result_top100": f"{_RESULT} ORDER BY eclassnumber, prediction LIMIT 100",
    "chart_series": f"""WITH r AS (SELECT CAST(floor(eclassnumber) AS INT) AS actual, prediction
  FROM ({_RESULT}))
SELECT actual, 'prediction' AS series, prediction AS value FROM r
UNION ALL SELECT actual, 'identity' AS series, actual AS value FROM r""",
    "chart_bins": f"""SELECT CAST(floor(eclassnumber / 5000) * 5000 AS BIGINT) AS actual_bin,
  CAST(floor(prediction / 5000.0) * 5000 AS BIGINT) AS prediction_bin, count(*) AS n
FROM ({_RESULT}) GROUP BY ALL""",
}
