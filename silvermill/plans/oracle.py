"""The registered queries once more, as SQL over the same tables."""

from __future__ import annotations

PART_DATE = "strftime(ts, '%Y%m%d')"
PART_TIME = "CASE WHEN hour(ts) < 12 THEN '080000' ELSE '200000' END"
PART_SEQ = f"CAST({PART_DATE} || {PART_TIME} AS BIGINT)"

ORDER_COLUMNS = "o_orderkey, o_orderstatus, o_custkey, o_totalprice, o_orderpriority"
CHANGED_COLUMNS = "o_orderkey, o_orderstatus, o_custkey, o_totalprice * 2 AS o_totalprice, o_orderpriority"
BEFORE = "o_orderdate < TIMESTAMP '1999-01-01'"
SINCE = "o_orderdate >= TIMESTAMP '1997-01-01'"


def unknown_status(columns: str) -> str:
    return columns.replace("o_orderstatus", "nullif(o_orderstatus, 'P') AS o_orderstatus")


def merge(target: str, source: str, keys: tuple[str, ...], columns: tuple[str, ...], null_safe=False) -> str:
    """MERGE with update-all and insert-all, spelled out."""
    operator = "IS NOT DISTINCT FROM" if null_safe else "="
    match = " AND ".join(f"t.{k} {operator} s.{k}" for k in keys)
    values = ", ".join(
        f"t.{c}" if c in keys else f"CASE WHEN s.matched THEN s.{c} ELSE t.{c} END AS {c}"
        for c in columns
    )
    names = ", ".join(columns)
    return f"""
        WITH t AS ({target}), s AS (SELECT *, TRUE AS matched FROM ({source}) AS x)
        SELECT {values} FROM t LEFT JOIN s ON {match}
        UNION ALL
        SELECT {names} FROM s WHERE NOT EXISTS (SELECT 1 FROM t WHERE {match})
    """


ORDERS = ("o_orderkey", "o_orderstatus", "o_custkey", "o_totalprice", "o_orderpriority")
ORDER_KEYS = ("o_orderkey", "o_orderstatus")
ORDERS_BEFORE = f"SELECT {ORDER_COLUMNS} FROM orders WHERE {BEFORE}"
ORDERS_SINCE = f"SELECT {CHANGED_COLUMNS} FROM orders WHERE {SINCE}"
UNKNOWN_BEFORE = f"SELECT {unknown_status(ORDER_COLUMNS)} FROM orders WHERE {BEFORE}"
UNKNOWN_SINCE = f"SELECT {unknown_status(CHANGED_COLUMNS)} FROM orders WHERE {SINCE}"

NO_LINES = "SELECT * FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)"

CREDIT = "concat_ws('-', 'c', l_orderkey, l_linenumber, l_partkey)"
CAST_ROWS = f"""
    SELECT CAST(l_orderkey AS VARCHAR) AS movie_id, 'Order ' || l_orderkey AS title,
           l_linenumber AS cast_id, l_returnflag AS character, {CREDIT} AS credit_id,
           CASE WHEN l_returnflag = 'A' THEN 1 ELSE 2 END AS gender,
           CAST(l_partkey AS INTEGER) AS id, 'part ' || l_partkey AS name,
           year(l_shipdate) AS y
    FROM lineitem
    UNION ALL
    SELECT CAST(l_orderkey AS VARCHAR), 'Order ' || l_orderkey,
           l_linenumber + 100, l_linestatus,
           CASE WHEN l_returnflag <> 'R' THEN {CREDIT} || '-s' ELSE '0000000000' END,
           0, CAST(l_suppkey AS INTEGER), 'supplier ' || l_suppkey, year(l_shipdate)
    FROM lineitem
    UNION ALL
    SELECT CAST(o_orderkey AS VARCHAR), 'Order ' || o_orderkey, NULL, NULL,
           '0000000000', NULL, NULL, NULL, year(o_orderdate)
    FROM ({NO_LINES}) AS n
"""
CREW_ROWS = f"""
    SELECT CAST(l_orderkey AS VARCHAR) AS movie_id, 'Order ' || l_orderkey AS title,
           CASE WHEN l_linestatus = 'O' THEN {CREDIT} || '-w' ELSE '0000000000' END AS credit_id,
           l_returnflag AS department, 1 AS gender, CAST(l_suppkey AS INTEGER) AS id,
           l_linestatus AS job, 'supplier ' || l_suppkey AS name, year(l_shipdate) AS y
    FROM lineitem
    UNION ALL
    SELECT CAST(o_orderkey AS VARCHAR), 'Order ' || o_orderkey, '0000000000',
           NULL, NULL, NULL, NULL, NULL, year(o_orderdate)
    FROM ({NO_LINES}) AS n
"""

ORIGINAL_TITLE = """CASE WHEN o_orderpriority NOT LIKE '5%'
    THEN 'Order ' || o_orderkey || ' of ' || o_custkey END"""


def movie_rows(revised: bool = False) -> str:
    votes = "o_custkey + 1" if revised else "o_custkey"
    return f"""
        SELECT CAST(o_orderkey AS VARCHAR) AS movie_id, 'Order ' || o_orderkey AS title,
               round(o_totalprice * 100) AS budget,
               'http://example.org/' || o_orderkey AS homepage,
               o_orderstatus AS original_language, {ORIGINAL_TITLE} AS original_title,
               o_orderpriority AS overview,
               CAST(CAST(o_custkey / 8 AS FLOAT) AS DOUBLE) AS popularity,
               strftime(o_orderdate, '%Y-%m-%d') AS release_date,
               CAST(o_custkey AS DOUBLE) AS revenue,
               CASE WHEN o_orderstatus <> 'P' THEN CAST(trunc(o_custkey / 2) AS INTEGER) END AS runtime,
               o_orderstatus AS status,
               CASE WHEN o_orderstatus = 'F' THEN o_orderpriority END AS tagline,
               CAST(CAST(o_custkey / 4 AS FLOAT) AS DOUBLE) AS vote_average,
               CAST({votes} AS INTEGER) AS vote_count
        FROM orders
    """


def list_rows(key: str, name: str, missing: str, revised: bool = False) -> str:
    """Rows of a movie list: `key` and `name` in terms of code and number."""
    priority = "substr(o_orderpriority, 1, 1)"
    if revised:
        priority = f"translate({priority}, '12345', '23451')"
    return f"""
        SELECT CAST(o_orderkey AS VARCHAR) AS movie_id, coalesce({key}, {missing}) AS other,
               {name} AS label
        FROM (
            SELECT o_orderkey, o_orderstatus AS code, o_custkey AS number FROM orders
            WHERE {priority} IN ('1', '2')
            UNION ALL
            SELECT o_orderkey, NULL, o_orderkey + 1000000 FROM orders WHERE {priority} = '1'
        ) AS elements
        UNION ALL
        SELECT CAST(o_orderkey AS VARCHAR), {missing}, NULL FROM orders
        WHERE {priority} NOT IN ('1', '2')
    """


NUMBER = "CAST(number AS INTEGER)"
TEXT = "CAST(number AS VARCHAR)"
LISTS = {
    "genres": ("id", NUMBER, "code", "-9999"),
    "keywords": ("id", f"CASE WHEN code IS NOT NULL THEN {NUMBER} END", "'word'", "-9999"),
    "production_companies": ("id", NUMBER, "'firm'", "-9999"),
    "production_countries": ("iso_3166_1", "code", TEXT, "'XX'"),
    "spoken_languages": ("iso_639_1", "code", TEXT, "'XX'"),
}


def list_table(name: str, revised: bool = False) -> str:
    field, key, label, missing = LISTS[name]
    inner = list_rows(key, label, missing, revised)
    return f"SELECT movie_id, other AS {field}, label AS name FROM ({inner}) AS r"


def list_merged(name: str) -> str:
    """First the orders as they were, then the revised ones over them."""
    field = LISTS[name][0]
    return f"""
        SELECT '{name}' AS table_name, movie_id, CAST({field} AS VARCHAR) AS other_key, name AS label
        FROM (
            SELECT *, row_number() OVER (PARTITION BY movie_id, {field} ORDER BY seq DESC, name DESC NULLS LAST) AS place
            FROM (
                SELECT *, 1 AS seq FROM ({list_table(name)}) AS a
                UNION ALL
                SELECT *, 2 AS seq FROM ({list_table(name, revised=True)}) AS b
            ) AS both_days
        ) AS ranked WHERE place = 1
    """


MOVIES_MERGED = f"""
    SELECT 'movies' AS table_name, movie_id, original_title AS other_key,
           CAST(vote_count AS VARCHAR) AS label
    FROM (
        SELECT movie_id, original_title, vote_count FROM ({movie_rows(revised=True)}) AS b
        UNION ALL
        SELECT movie_id, original_title, vote_count FROM ({movie_rows()}) AS a
        WHERE original_title IS NULL
    ) AS merged
"""


def credits_merged(name: str, rows: str, rest: str, label: str) -> str:
    order = ", ".join(f"{c} DESC NULLS LAST" for c in ("y", *rest.split()))
    return f"""
        SELECT '{name}' AS table_name, movie_id, credit_id AS other_key, {label} AS label
        FROM (
            SELECT *, row_number() OVER (PARTITION BY credit_id, movie_id ORDER BY {order}) AS place
            FROM ({rows}) AS r
        ) AS ranked WHERE place = 1
    """


def quality(name: str, rows: str, null_key: str, sentinel: str) -> str:
    return f"""
        SELECT '{name}' AS table_name, count(*) AS rows,
               count(*) FILTER ({null_key}) AS null_key_rows,
               count(*) FILTER ({sentinel}) AS sentinel_rows
        FROM ({rows}) AS r
    """


def union(parts) -> str:
    return " UNION ALL ".join(parts)


BRONZE_MOVIE_NULLS = {
    "id": "0", "title": "0", "budget": "0", "homepage": "0", "original_language": "0",
    "original_title": "count(*) FILTER (o_orderpriority LIKE '5%')",
    "overview": "0", "popularity": "0", "release_date": "0", "revenue": "0",
    "runtime": "count(*) FILTER (o_orderstatus = 'P')",
    "status": "0",
    "tagline": "count(*) FILTER (o_orderstatus <> 'F')",
    "vote_average": "0", "vote_count": "0",
    **{name: "count(*) FILTER (o_orderpriority LIKE '5%')" for name in LISTS},
    "order_year": "0",
}
MOVIE_TYPES = {
    "movie_id": "string", "title": "string", "budget": "double", "homepage": "string",
    "original_language": "string", "original_title": "string", "overview": "string",
    "popularity": "float", "release_date": "date", "revenue": "double", "runtime": "int",
    "status": "string", "tagline": "string", "vote_average": "float", "vote_count": "int",
}


def all_sql() -> dict[str, str]:
    sql = {
        "read_parts": f"""
            SELECT event_id, {PART_DATE} AS part_date, {PART_TIME} AS part_time,
                   {PART_SEQ} AS part_seq FROM events""",
        "read_parts_of_days": f"""
            SELECT event_id, event_type, {PART_SEQ} AS part_seq FROM events
            WHERE ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-21'""",
        "list_parts": f"""
            SELECT DISTINCT {PART_DATE} AS part_date, {PART_TIME} AS part_time,
                   {PART_SEQ} AS part_seq FROM events""",
        "list_objects": f"SELECT DISTINCT {PART_DATE} AS part_date, TRUE AS has_bytes FROM events",
        "objects_with_prefix": f"""
            SELECT DISTINCT {PART_DATE} AS part_date, TRUE AS has_bytes FROM events
            WHERE ts >= TIMESTAMP '2024-01-01' AND ts < TIMESTAMP '2024-01-10'""",
        "read_parts_drift": """
            SELECT event_id, event_type, CASE WHEN hour(ts) >= 12 THEN props END AS props,
                   CASE WHEN hour(ts) < 12 THEN 20240101080000 ELSE 20240101200000 END AS part_seq
            FROM events""",
        "part_load_counts": f"""
            SELECT part_seq, new_rows,
                   CAST(sum(new_rows) OVER (ORDER BY part_seq) AS BIGINT) AS merged_rows
            FROM (SELECT {PART_SEQ} AS part_seq, count(*) AS new_rows FROM events GROUP BY 1) AS p""",
        "json_field": "SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events",
        "json_lone_object": "SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events",
        "normalize_array": f"""
            SELECT CAST(l_orderkey AS VARCHAR) AS order_key, CAST(l_partkey AS INTEGER) AS id,
                   'part ' || l_returnflag AS name FROM lineitem
            UNION ALL
            SELECT CAST(l_orderkey AS VARCHAR),
                   CASE WHEN l_linestatus <> 'F' THEN CAST(l_suppkey AS INTEGER) ELSE -9999 END,
                   'supplier' FROM lineitem
            UNION ALL
            SELECT CAST(o_orderkey AS VARCHAR), -9999, NULL FROM ({NO_LINES}) AS n""",
        "normalize_array_titled": """
            SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name,
                   coalesce(CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderkey AS VARCHAR) END,
                            '0000000000') AS order_ref,
                   o_orderpriority AS priority
            FROM customer LEFT JOIN orders ON o_custkey = c_custkey""",
        "normalize_string_key": """
            SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, substr(p_type, 1, 2) AS code, p_type AS name FROM part
            UNION ALL
            SELECT CAST(p_partkey AS VARCHAR), CASE WHEN p_size >= 25 THEN p_brand ELSE 'XX' END, p_name FROM part""",
        "normalize_words": """
            SELECT CAST(doc_id AS VARCHAR) AS doc_id,
                   CAST(unnest(range(len(words))) AS INTEGER) AS id, unnest(words) AS name
            FROM (SELECT doc_id, string_split(text, ' ') AS words FROM documents) AS d""",
        "typed_projection": """
            SELECT CAST(o_orderkey AS VARCHAR) AS order_key, CAST(o_custkey AS INTEGER) AS customer,
                   strftime(o_orderdate, '%Y-%m-%d') AS day,
                   CASE WHEN o_orderstatus <> 'P' THEN CAST(trunc(o_totalprice) AS INTEGER) END AS whole_price,
                   o_totalprice AS price, CAST(o_custkey AS INTEGER) AS text_number,
                   CAST(NULL AS INTEGER) AS bad_number
            FROM orders""",
        "upsert_orders": merge(ORDERS_BEFORE, ORDERS_SINCE, ORDER_KEYS, ORDERS),
        "upsert_null_keys": merge(UNKNOWN_BEFORE, UNKNOWN_SINCE, ORDER_KEYS, ORDERS),
        "upsert_null_safe": merge(UNKNOWN_BEFORE, UNKNOWN_SINCE, ORDER_KEYS, ORDERS, null_safe=True),
        "upsert_dup_target": merge(
            "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem",
            """SELECT l_orderkey, l_linenumber, sum(l_quantity) AS l_quantity FROM lineitem GROUP BY 1, 2
               UNION ALL SELECT o_orderkey, 0, 0.0 FROM orders""",
            ("l_orderkey", "l_linenumber"), ("l_orderkey", "l_linenumber", "l_quantity"),
        ),
        "upsert_latest": merge(
            "SELECT c_custkey, c_name, 0.0::DOUBLE AS price FROM customer",
            """SELECT o_custkey AS c_custkey, o_orderpriority AS c_name, o_totalprice AS price FROM (
                   SELECT *, row_number() OVER (PARTITION BY o_custkey
                       ORDER BY o_totalprice DESC, o_orderpriority DESC) AS place
                   FROM orders) AS ranked WHERE place = 1""",
            ("c_custkey",), ("c_custkey", "c_name", "price"),
        ),
        "upsert_parts": f"""
            SELECT user_id, event_type, event_id, value, {PART_SEQ} AS part_seq FROM (
                SELECT *, row_number() OVER (PARTITION BY user_id, event_type
                    ORDER BY {PART_SEQ} DESC, ts DESC, event_id DESC) AS place
                FROM events) AS ranked WHERE place = 1""",
        "silver_merge": merge(UNKNOWN_BEFORE, UNKNOWN_SINCE, ORDER_KEYS, ORDERS),
        "silver_merge_blooms": merge(UNKNOWN_BEFORE, UNKNOWN_SINCE, ORDER_KEYS, ORDERS),
        "merge_bucketed": merge(UNKNOWN_BEFORE, UNKNOWN_SINCE, ORDER_KEYS, ORDERS),
        "csv_quoted_lines": """
            SELECT doc_id, lang, length(text)::BIGINT AS n_chars, sha256(text) AS text_sha256 FROM documents""",
        "element_drift": """
            SELECT 'id' AS field, TRUE AS declared,
                   count(*) FILTER (l_returnflag = 'R' OR l_linestatus = 'F') AS n_elements, 0::BIGINT AS n_null,
                   count(*) FILTER (l_returnflag <> 'R' AND l_linestatus = 'F') AS n_other_type FROM lineitem
            UNION ALL SELECT 'name', TRUE, count(*), 0, count(*) FILTER (l_returnflag = 'R') FROM lineitem
            UNION ALL SELECT 'extra', FALSE, count(*) FILTER (l_returnflag = 'A'), 0, 0 FROM lineitem
            UNION ALL SELECT NULL, FALSE, n, n, n FROM (
                SELECT count(*) FILTER (l_returnflag = 'R') AS n FROM lineitem) WHERE n > 0""",
        "page_of_rows": """
            SELECT l_extendedprice, l_orderkey, l_linenumber, l_partkey, row_number FROM (
                SELECT *, row_number() OVER (ORDER BY l_extendedprice DESC, l_orderkey DESC,
                                             l_linenumber DESC, l_partkey DESC) AS row_number FROM lineitem)
            WHERE row_number BETWEEN 3001 AND 4000""",
        "silver_bootstrap": ORDERS_SINCE,
        "overwrite_roundtrip": "SELECT * FROM customer",
        "append_load": f"{ORDERS_BEFORE} UNION ALL {ORDERS_SINCE}",
        "append_union": f"{ORDERS_BEFORE} UNION ALL {ORDERS_SINCE}",
        "raw_data_files": "SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier",
        "snapshot_roundtrip": "SELECT * FROM part",
        "csv_roundtrip": """SELECT CAST(o_orderkey AS INTEGER) AS o_orderkey, o_orderpriority, o_totalprice FROM orders""",
        "csv_push_pull": "SELECT CAST(c_custkey AS INTEGER) AS c_custkey, c_name, c_nationkey FROM customer",
        "load_credits": union([
            credits_merged("cast", CAST_ROWS, "title cast_id character gender id name", "character"),
            credits_merged("crew", CREW_ROWS, "title department gender id job name", "department"),
        ]),
        "load_movies": union([MOVIES_MERGED, *[list_merged(name) for name in LISTS]]),
        "load_replace_sentinel": f"""
            SELECT * FROM ({list_merged("genres")}) AS g
            WHERE NOT (other_key = '-9999' AND movie_id IN (
                SELECT movie_id FROM ({list_merged("genres")}) AS b WHERE other_key <> '-9999'))""",
        "append_parts": union(
            f"""SELECT 'spoken_languages' AS table_name, movie_id, iso_639_1 AS other_key, name AS label
                FROM ({list_table("spoken_languages", revised)}) AS l"""
            for revised in (False, True)
        ),
        "run_report": union([
            f"""SELECT 'cast' AS "table", 'credits' AS source, count(*) AS rows_in, TRUE AS timed FROM ({CAST_ROWS}) AS r""",
            f"""SELECT 'crew', 'credits', count(*), TRUE FROM ({CREW_ROWS}) AS r""",
            """SELECT 'movies', 'movies', 2 * count(*), TRUE FROM orders""",
            *[
                f"""SELECT '{name}', 'movies', count(*), TRUE FROM (
                    {list_table(name)} UNION ALL {list_table(name, True)}) AS r"""
                for name in LISTS
            ],
        ]),
        "stream_ingest": f"""
            SELECT user_id, event_type, event_id, value FROM (
                SELECT *, row_number() OVER (PARTITION BY user_id, event_type
                    ORDER BY {PART_SEQ} DESC, event_id DESC) AS place
                FROM events) AS ranked WHERE place = 1""",
        "stream_by_name": f"""
            SELECT user_id, event_type, event_id, value FROM (
                SELECT *, row_number() OVER (PARTITION BY user_id, event_type
                    ORDER BY {PART_SEQ} DESC, event_id DESC) AS place
                FROM events) AS ranked WHERE place = 1""",
        "filter_clustered": """
            SELECT o_orderkey, o_custkey, o_totalprice, 'customer' AS found_by FROM orders
            WHERE o_custkey BETWEEN 20 AND 40
            UNION ALL
            SELECT o_orderkey, o_custkey, o_totalprice, 'month' FROM orders
            WHERE o_orderdate >= TIMESTAMP '1996-08-01' AND o_orderdate < TIMESTAMP '1996-09-01'""",
        "filter_text": f"SELECT * EXCLUDE (y) FROM ({CAST_ROWS}) AS r WHERE credit_id = '0000000000'",
        "filter_number": f"SELECT * FROM ({list_table('genres')}) AS r WHERE id = -9999",
        "filter_number_as_text": f"SELECT * FROM ({list_table('keywords')}) AS r WHERE id = -9999",
        "filter_null": """
            SELECT CAST(o_orderkey AS VARCHAR) AS movie_id, 'Order ' || o_orderkey AS title
            FROM orders WHERE o_orderpriority LIKE '5%'""",
        "repair_fill": """
            SELECT o_orderkey, coalesce(nullif(o_orderstatus, 'P'), 'XX') AS o_orderstatus FROM orders""",
        "row_count": "SELECT count(*) AS rows FROM lineitem",
        "filtered_count": f"SELECT count(*) AS rows FROM ({CREW_ROWS}) AS r WHERE credit_id = '0000000000'",
        "distinct_count": f"""
            SELECT count(*) AS distinct_values FROM (SELECT DISTINCT character FROM ({CAST_ROWS}) AS r) AS d""",
        "distinct_estimates": union(
            f"""SELECT '{name}' AS column_name, count(*) AS rows, count(*) FILTER ({missing}) AS missing,
                       count(DISTINCT {name}) + count(DISTINCT CASE WHEN {name} IS NULL THEN 1 END) AS distinct_values,
                       TRUE AS within_bound FROM events"""
            for name, missing in {
                **{name: f"{name} IS NULL" for name in ("event_id", "ts", "user_id", "event_type", "props")},
                "value": "value IS NULL OR isnan(value)",
            }.items()
        ),
        "profile_refresh": union(
            f"""SELECT '{name}' AS column_name, count(*) AS rows, count(*) FILTER ({name} IS NULL) AS missing
                FROM ({merge(UNKNOWN_BEFORE, UNKNOWN_SINCE, ORDER_KEYS, ORDERS)}) AS merged"""
            for name in ORDERS
        ),
        "distinct_rows": "SELECT DISTINCT user_id, event_type FROM events",
        "null_profile": union(
            f"SELECT '{name}' AS column_name, CAST({count if count != '0' else '0 * count(*)'} AS BIGINT) AS null_count FROM orders"
            for name, count in BRONZE_MOVIE_NULLS.items()
        ),
        "schema_rows": union(
            f"""SELECT {i} AS position, '{name}' AS column_name, '{kind}' AS data_type,
                       count({name}) AS value_count FROM ({movie_rows()}) AS r"""
            for i, (name, kind) in enumerate(MOVIE_TYPES.items())
        ),
        "quality_report": union([
            quality("cast", CAST_ROWS, "credit_id IS NULL", "credit_id = '0000000000'"),
            quality("crew", CREW_ROWS, "credit_id IS NULL", "credit_id = '0000000000'"),
            quality("movies", movie_rows(), "original_title IS NULL", "FALSE"),
            *[
                quality(name, list_table(name), f"{field} IS NULL", f"{field} = {missing}")
                for name, (field, _, _, missing) in LISTS.items()
            ],
        ]),
        "silver_quality": union([
            quality("movies", MOVIES_MERGED, "other_key IS NULL", "FALSE"),
            quality(
                "keywords", list_merged("keywords"), "other_key IS NULL", "other_key = '-9999'"
            ),
        ]),
        "malformed_report": union(
            f"""SELECT '{name}' AS column_name, count(*) AS rows,
                       count(*) FILTER (o_orderpriority LIKE '5%') AS blank_rows,
                       count(*) FILTER (o_orderpriority LIKE '4%') AS malformed_rows
                FROM orders"""
            for name in LISTS
        ),
        "sort_ascending": f"SELECT * FROM ({list_table('production_companies')}) AS r ORDER BY id, movie_id",
        "sort_descending": f"""
            SELECT * FROM ({list_table('spoken_languages')}) AS r ORDER BY iso_639_1 DESC, movie_id DESC""",
        "top_rows": """
            SELECT l_extendedprice, l_orderkey, l_linenumber, l_partkey FROM lineitem
            ORDER BY 1 DESC, 2 DESC, 3 DESC, 4 DESC LIMIT 20""",
        "table_cast": f"SELECT * EXCLUDE (y) FROM ({CAST_ROWS}) AS r",
        "table_crew": f"SELECT * EXCLUDE (y) FROM ({CREW_ROWS}) AS r",
        "table_movies": movie_rows(),
    }
    sql.update({f"table_{name}": list_table(name) for name in LISTS})
    return sql
