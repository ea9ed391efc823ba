"""The same results as SQL over the given tables, by query name."""

from usagelens.operators.sampling import poisson_steps
from usagelens.schemas import RAW_MEASURES, STAT_COLUMNS
from usagelens.sources.files import MISSING_TEXTS

START, END = "2024-01-08", "2024-01-17"

VIEWS = {
    "cdr": """
        SELECT *, CASE WHEN lead(DP_DATE) OVER (PARTITION BY DP_MSISDN ORDER BY DP_DATE)
                            <= DP_DATE + 1 THEN 0 ELSE 1 END AS PSEUDO_CHURNED
        FROM (
            SELECT min(event_id) AS id, CAST(ts AS DATE) AS DP_DATE, min(ts) AS DP_TS,
                   user_id AS DP_MSISDN,
                   CAST(count(*) FILTER (event_type = 'click') AS INTEGER) AS DP_MOC_COUNT,
                   sum(value) FILTER (event_type = 'click') AS DP_MOC_DURATION,
                   CAST(count(*) FILTER (event_type = 'view') AS INTEGER) AS DP_MTC_COUNT,
                   sum(value) FILTER (event_type = 'view') AS DP_MTC_DURATION,
                   CAST(count(*) FILTER (event_type = 'signup') AS INTEGER) AS DP_MOSMS_COUNT,
                   CAST(count(*) FILTER (event_type = 'error') AS INTEGER) AS DP_MTSMS_COUNT,
                   CAST(count(*) FILTER (event_type = 'purchase') AS INTEGER) AS DP_DATA_COUNT,
                   sum(value) FILTER (event_type = 'purchase') AS DP_DATA_VOLUME
            FROM events GROUP BY user_id, CAST(ts AS DATE)
        )""",
    "processed": """
        SELECT CAST(DP_DATE AS VARCHAR) AS "Date", CAST(DP_MSISDN AS VARCHAR) AS "User",
               DP_MOC_COUNT AS "M_Out_Call_Count", DP_MOC_DURATION AS "M_Out_Call_Time",
               DP_DATA_VOLUME AS "M_Data_Sum", DP_DATA_COUNT AS "M_Data_Count",
               DP_MTC_COUNT AS "M_In_Call_Count", DP_MTC_DURATION AS "M_In_Call_Time",
               PSEUDO_CHURNED AS "M_Tenure_Churn"
        FROM cdr""",
    "labelled": """SELECT * FROM processed WHERE "Date" < (SELECT max("Date") FROM processed)""",
    "predictions": """
        SELECT "Date", "User", label, CASE WHEN p >= 0.5 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS prediction,
               1 - p AS probability_0, p AS probability_1
        FROM (SELECT "Date", "User", "M_Tenure_Churn" AS label,
                     (M_In_Call_Count + 1)::DOUBLE
                         / (M_In_Call_Count + M_Data_Count + M_Out_Call_Count + 2) AS p
              FROM labelled)""",
    "cdr_lines": """
        SELECT CAST(l_shipdate AS DATE) AS DP_DATE, l_suppkey AS DP_MSISDN,
               CAST(trunc(l_quantity) AS INTEGER) AS DP_MOC_COUNT, l_extendedprice AS DP_MOC_DURATION,
               l_linenumber AS DP_MTC_COUNT, l_extendedprice * l_tax AS DP_MTC_DURATION,
               l_linenumber AS DP_DATA_COUNT, l_extendedprice * l_discount AS DP_DATA_VOLUME,
               CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS PSEUDO_CHURNED
        FROM lineitem""",
}
NEEDS = {
    "cdr": [],
    "processed": ["cdr"],
    "labelled": ["processed"],
    "predictions": ["labelled"],
    "cdr_lines": [],
}
VIEWS["processed_lines"] = VIEWS["processed"].replace("FROM cdr", "FROM cdr_lines")
NEEDS["processed_lines"] = ["cdr_lines"]

PROCESSED = [
    "Date",
    "User",
    "M_Out_Call_Count",
    "M_Out_Call_Time",
    "M_Data_Sum",
    "M_Data_Count",
    "M_In_Call_Count",
    "M_In_Call_Time",
    "M_Tenure_Churn",
]
DOUBLES = {
    "M_Out_Call_Time",
    "M_Data_Sum",
    "M_In_Call_Time",
    "DP_MOC_DURATION",
    "DP_MTC_DURATION",
    "DP_DATA_VOLUME",
}


def over(view: str, body: str, **extra: str) -> str:
    """``body`` with the views it stands on, and ``extra`` ones after them."""
    order = []

    def add(name):
        for needed in NEEDS[name]:
            add(needed)
        if name not in order:
            order.append(name)

    add(view)
    ctes = [f"{name} AS ({VIEWS[name]})" for name in order]
    ctes += [f"{name} AS ({text})" for name, text in extra.items()]
    return "WITH " + ",\n".join(ctes) + "\n" + body


def rnd(expression: str, name: str, digits: int = 6) -> str:
    return f'round({expression}, {digits}) AS "{name}"'


def cols(names, digits: int = 6) -> str:
    """Columns under their own names, doubles rounded."""
    return ", ".join(rnd(f'"{n}"', n, digits) if n in DOUBLES else f'"{n}"' for n in names)


def union(parts) -> str:
    return "\nUNION ALL\n".join(parts)


ROWS = cols(PROCESSED)
FILLED = ", ".join(
    rnd(f'coalesce("{c}", 0)', c) if c in DOUBLES else f'"{c}"' for c in PROCESSED
)
NUMBERS = ", ".join(
    [
        "id::DOUBLE AS id",
        "CAST(DP_DATE AS VARCHAR) AS DP_DATE",
        "DP_MSISDN::DOUBLE AS DP_MSISDN",
        *[rnd(f"{c}::DOUBLE", c) for c in RAW_MEASURES],
        "PSEUDO_CHURNED::DOUBLE AS PSEUDO_CHURNED",
    ]
)


def summary(view: str, start: str, end: str) -> str:
    return over(
        view,
        f"""
        SELECT DP_DATE AS "Date", CAST(sum(DP_MOC_COUNT) AS BIGINT) AS "Total_Outgoing_Calls",
               CAST(round(sum(DP_MOC_DURATION)) AS BIGINT) AS "Total_Outgoing_Call_Time",
               CAST(sum(DP_DATA_COUNT) AS BIGINT) AS "Total_Data_Purchases",
               round(sum(DP_DATA_VOLUME), 2) AS "Total_Data_Volume"
        FROM {view} WHERE DP_DATE BETWEEN DATE '{start}' AND DATE '{end}' GROUP BY 1""",
    )


def skew(x: str) -> str:
    """Population skewness from centred moments."""
    return (
        f"CASE WHEN var_pop({x}) = 0 THEN NULL WHEN count({x}) > 2 THEN"
        f" skewness({x}) * (count({x}) - 2) / sqrt(count({x})::DOUBLE * (count({x}) - 1)) END"
    )


def centred_skew(x: str, view: str, where: str) -> str:
    return (
        f"(SELECT avg(({x} - m) ** 3) / pow(avg(({x} - m) ** 2), 1.5)"
        f" FROM {view}, (SELECT avg({x}) AS m FROM {view} WHERE {where}) WHERE {where})"
    )


def class_stats(columns, digits: int) -> str:
    made = []
    for c in columns:
        text = c in ("Date", "User")
        x = f'TRY_CAST("{c}" AS DOUBLE)' if text else f'"{c}"'
        total = rnd(f"sum({x})", f"{c}_sum", digits)
        whole = not text and c not in DOUBLES
        made += [
            f'CAST(sum({x}) AS BIGINT) AS "{c}_sum"' if whole else total,
            rnd(f"avg({x})", f"{c}_avg", digits),
            rnd(f'min("{c}")', f"{c}_min", digits) if c in DOUBLES else f'min("{c}") AS "{c}_min"',
            rnd(f'max("{c}")', f"{c}_max", digits) if c in DOUBLES else f'max("{c}") AS "{c}_max"',
            f'count("{c}") AS "{c}_count"',
            rnd(f"var_samp({x}::DOUBLE)", f"{c}_variance", digits),
            rnd(skew(f"{x}::DOUBLE"), f"{c}_skewness", digits),
        ]
    return f'SELECT "M_Tenure_Churn", {", ".join(made)} FROM source GROUP BY "M_Tenure_Churn"'


def described(view: str, columns, digits: int) -> str:
    return union(
        f"""SELECT '{c}' AS "column", count({c}) AS "count", {rnd(f"avg({c})", "mean", digits)},
            {rnd(f"stddev_samp({c})", "std", digits)}, {rnd(f"min({c})::DOUBLE", "min", digits)},
            {rnd(f"quantile_cont({c}::DOUBLE, 0.25)", "q25", digits)},
            {rnd(f"quantile_cont({c}::DOUBLE, 0.5)", "q50", digits)},
            {rnd(f"quantile_cont({c}::DOUBLE, 0.75)", "q75", digits)},
            {rnd(f"max({c})::DOUBLE", "max", digits)} FROM {view}"""
        for c in columns
    )


NUMERIC_FEATURES = [c for c in PROCESSED if c not in ("Date", "User", "M_Tenure_Churn")]


def correlations(view: str) -> str:
    return union(
        f"""SELECT '{c}' AS feature,
            round(corr("M_Tenure_Churn"::DOUBLE, coalesce("{c}", 0)::DOUBLE), 6) AS correlation
            FROM {view}"""
        for c in NUMERIC_FEATURES
    )


RAW_FEATURES = ["id", "DP_MSISDN", *RAW_MEASURES]


def r2(view: str, x: str, y: str, name: str) -> str:
    return f"""SELECT '{name}' AS feature, count(*) AS n,
        round(CASE WHEN sum((x - m) ** 2) = 0 THEN CASE WHEN sum((x - y) ** 2) = 0 THEN 1 ELSE 0 END
              ELSE 1 - sum((x - y) ** 2) / sum((x - m) ** 2) END, 6) AS r2
        FROM (SELECT x, y, avg(x) OVER () AS m FROM (SELECT {x} AS x, {y} AS y FROM {view})
              WHERE x IS NOT NULL AND y IS NOT NULL) HAVING count(*) > 1"""


def date_stats(columns, view: str) -> str:
    """Rows with the statistics of their date."""
    made = []
    for c in columns:
        total = f'sum("{c}") OVER d'
        if c not in DOUBLES:
            total = f"CAST({total} AS BIGINT)"
        made += [
            f'{total} AS "{c}_sum"',
            f'avg("{c}") OVER d AS "{c}_mean"',
            f'stddev_samp("{c}") OVER d AS "{c}_stddev"',
        ]
    return f'SELECT *, {", ".join(made)} FROM {view} WINDOW d AS (PARTITION BY "Date")'


STATS = [f"{c}_{s}" for c in STAT_COLUMNS for s in ("sum", "mean", "stddev")]


def stat_cols(columns, digits: int = 6) -> str:
    made = []
    for c in columns:
        total = rnd(f'"{c}_sum"', f"{c}_sum", digits) if c in DOUBLES else f'"{c}_sum"'
        made += [
            total,
            rnd(f'"{c}_mean"', f"{c}_mean", digits),
            rnd(f'"{c}_stddev"', f"{c}_stddev", digits),
        ]
    return ", ".join(made)


def log1p(name: str) -> str:
    return f'CASE WHEN "{name}" > -1 THEN ln(1 + "{name}") END'


def features(view: str, filled_first: bool) -> str:
    """The feature table; ``view`` is read as is, or with 0 for NULL."""
    numeric = [c for c in PROCESSED if c not in ("Date", "User")]
    filled = f"""SELECT * REPLACE ({", ".join(f'coalesce("{c}", 0) AS "{c}"' for c in numeric)})
                 FROM {view}"""

    def last(expression):
        return expression if filled_first else f"coalesce({expression}, 0)"

    plain = STAT_COLUMNS + STATS
    real = DOUBLES | {s for s in STATS if not s.endswith("_sum") or s[:-4] in DOUBLES}
    made = ['"Date"', '"User"', '"M_Tenure_Churn" AS label']
    for c in [n for n in numeric if n != "M_Tenure_Churn"] + STATS:
        value = last(f'"{c}"')
        made.append(rnd(value, c, 9) if c in real else f'{value} AS "{c}"')
    made += [rnd(last(log1p(c)), f"{c}_log", 9) for c in plain]
    base = filled if filled_first else f"SELECT * FROM {view}"
    return over(
        view, f"SELECT {', '.join(made)} FROM stats", base=base, stats=date_stats(STAT_COLUMNS, "base")
    )


def metrics(source: str) -> str:
    """Per chunk of a view with chunk, day, label, prediction and score."""
    return f"""
        SELECT r.chunk, min(r.day) AS start_date, max(r.day) AS end_date, count(*) AS n,
               any_value(a.roc_auc) AS roc_auc,
               2.0 * count(*) FILTER (label = 1 AND prediction = 1)
                   / nullif(2.0 * count(*) FILTER (label = 1 AND prediction = 1)
                            + count(*) FILTER (label = 0 AND prediction = 1)
                            + count(*) FILTER (label = 1 AND prediction = 0), 0)::DOUBLE AS f1,
               avg(CASE WHEN label = prediction THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS accuracy
        FROM {source} r LEFT JOIN (
            SELECT chunk, (sum(place) FILTER (label = 1)
                           - count(*) FILTER (label = 1) * (count(*) FILTER (label = 1) + 1) / 2.0)
                          / nullif(count(*) FILTER (label = 1) * count(*) FILTER (label = 0), 0)
                          AS roc_auc
            FROM (SELECT chunk, label,
                         rank() OVER (PARTITION BY chunk ORDER BY score)
                         + (count(*) OVER (PARTITION BY chunk, score) - 1) / 2.0::DOUBLE AS place
                  FROM {source})
            GROUP BY chunk) a ON r.chunk = a.chunk
        GROUP BY r.chunk"""


BY_DAY = """SELECT CAST("Date" AS DATE) AS chunk, CAST("Date" AS DATE) AS day, label, prediction,
            probability_1 AS score FROM predictions"""
METRIC_COLS = (
    "chunk, start_date, end_date, n, round(roc_auc, 6) AS roc_auc, round(f1, 6) AS f1,"
    " round(accuracy, 6) AS accuracy"
)


BY_COUNT = """SELECT CAST(ntile(10) OVER (ORDER BY "Date", probability_1, label, prediction) AS VARCHAR)
            AS chunk, CAST("Date" AS DATE) AS day, label, prediction, probability_1 AS score FROM predictions"""


def report(judged: str, reference: str, chunks: str = BY_DAY) -> str:
    """Metrics of ``judged`` with bounds from ``reference``."""
    names = ["roc_auc", "f1", "accuracy"]
    limits = ", ".join(
        f"greatest(avg({m}) - 3 * stddev_pop({m}), 0) AS {m}_lower,"
        f" least(avg({m}) + 3 * stddev_pop({m}), 1) AS {m}_upper"
        for m in names
    )
    shown = ", ".join(
        f"round({m}_lower, 6) AS {m}_lower, round({m}_upper, 6) AS {m}_upper,"
        f" coalesce({m} < {m}_lower OR {m} > {m}_upper, false) AS {m}_alert"
        for m in names
    )
    return over(
        "predictions",
        f"SELECT {METRIC_COLS}, {shown} FROM judged, (SELECT {limits} FROM reference)",
        by_day=chunks,
        measured=metrics("by_day"),
        judged=f"SELECT * FROM measured {judged}",
        reference=f"SELECT * FROM measured {reference}",
    )


def exploration() -> str:
    """Every part of the exploration as (part, key, value, text)."""
    numeric = [c for c in PROCESSED if c not in ("Date", "User")]
    scaled = ["M_Tenure_Churn", "M_Data_Sum", "M_Data_Count"]
    made = []

    def add(part, key, value, source, text="NULL", where="true", group=""):
        made.append(
            f"""SELECT '{part}' AS part, {key} AS "key", round(({value})::DOUBLE, 4) AS "value",
                {text}::VARCHAR AS "text" FROM {source} WHERE {where} {group}"""
        )

    kind = '"M_Tenure_Churn"::DOUBLE::VARCHAR'
    for c in PROCESSED[:-1]:
        is_text = c in ("Date", "User")
        x = f'TRY_CAST("{c}" AS DOUBLE)' if is_text else f'"{c}"::DOUBLE'
        stats = {
            "sum": f"sum({x})",
            "avg": f"avg({x})",
            "count": f'count("{c}")',
            "variance": f"var_samp({x})",
            "skewness": skew(x),
        }
        for name, value in stats.items():
            add("class_summary", f"{kind} || '/{c}/{name}'", value, "filled", group='GROUP BY "M_Tenure_Churn"')
        for end in ("min", "max"):
            value, text = ("NULL", f'{end}("{c}")') if is_text else (f"{end}({x})", "NULL")
            add("class_summary", f"{kind} || '/{c}/{end}'", value, "filled", text, group='GROUP BY "M_Tenure_Churn"')
    add("profile", "'record_count'", "count(*)", "filled")
    add("profile", "'distinct_subscribers'", 'count(DISTINCT "User")', "filled")
    for c in PROCESSED:
        add("null_counts", f"'{c}'", f'count(*) - count("{c}")', "filled")
    add("class_counts", kind, "count(*)", "filled", group='GROUP BY "M_Tenure_Churn"')
    for part, source in (("moments", "filled"), ("scaled_moments", "scaled_rows")):
        x = '"M_Data_Sum"'
        add(part, "'skewness'", centred_skew(x, source, "true"), "(SELECT 1)")
        add(part, "'mean'", f"avg({x})", source)
        add(part, "'stddev'", f"stddev_samp({x})", source)
    for c in numeric[:-1]:
        add("correlations", f"'{c}'", "correlation", "correlated", where=f"feature = '{c}'")
    row = """"Date" || '/' || "User" || '/"""
    for c in scaled:
        add("scaled", f"{row}{c}'", f'"{c}"', "scaled_rows")
    add("reflected", f"{row}reflected'", '2 - "M_Data_Sum"', "scaled_rows")
    add("reflected", f"{row}adjusted'", '1 / nullif(ln(2 - "M_Data_Sum"), 0)', "scaled_rows")
    for name, value in (("left_edge", "lo + bin * w"), ("right_edge", "lo + (bin + 1) * w"), ("count", "coalesce(n, 0)")):
        add("histogram", f"bin || '/{name}'", value, "binned")
    for name, value in (("x", "place"), ("density", "density")):
        add("density", f"point || '/{name}'", value, "dense")
    for c in numeric[:-1]:
        for name, value in (("n", "count(*)"), ("mean", f'avg(ln(1 + "{c}"))'), ("std", f'stddev_samp(ln(1 + "{c}"))')):
            add(
                "log_profile",
                f"'{c}/{name}'",
                value,
                "filled",
                where=f""""{c}" > 0""",
                group=f"HAVING (SELECT feature FROM correlated ORDER BY correlation DESC, feature LIMIT 1) = '{c}'",
            )
    filled = ", ".join(f'coalesce("{c}", 0) AS "{c}"' for c in numeric)
    ranged = ", ".join(
        f'("{c}" - min("{c}") OVER ()) / nullif(max("{c}") OVER () - min("{c}") OVER (), 0)::DOUBLE AS "{c}"'
        for c in scaled
    )
    return over(
        "labelled",
        union(made),
        filled=f'SELECT "Date", "User", {filled} FROM labelled',
        correlated=f"""SELECT * FROM ({correlations("filled")})
                       WHERE correlation IS NOT NULL AND NOT isnan(correlation)""",
        scaled_rows=f'SELECT "Date", "User", {ranged} FROM filled',
        source='SELECT ln(1 + "M_Data_Sum") AS x FROM scaled_rows',
        spread="SELECT min(x) AS lo, (max(x) - min(x)) / 30 AS w FROM source",
        binned="""SELECT bin, lo, w, n FROM spread CROSS JOIN (SELECT unnest(range(30))::INTEGER AS bin)
                  LEFT JOIN (SELECT least(floor((x - lo) / w), 29)::INTEGER AS b, count(*) AS n
                             FROM source, spread GROUP BY 1) ON b = bin""",
        dense="""SELECT point, any_value(place) AS place,
                        sum(n * exp(-0.5 * ((place - x) / h) ** 2)) / any_value(total * h * sqrt(2 * pi())) AS density
                 FROM (SELECT x, count(*) AS n FROM source GROUP BY 1),
                      (SELECT point, lo + point * (hi - lo) / 199 AS place, total, std * total ** -0.2 AS h
                       FROM (SELECT unnest(range(200))::INTEGER AS point),
                            (SELECT min(x) AS lo, max(x) AS hi, count(*)::DOUBLE AS total,
                                    stddev_samp(x) AS std FROM source))
                 GROUP BY point""",
    )


PREDICTION_ROWS = (
    '"Date", "User", label, prediction, round(probability_0, 6) AS probability_0,'
    " round(probability_1, 6) AS probability_1"
)

ORACLES = {
    "scan_date_range": f"""SELECT event_id, user_id, event_type, value FROM events
        WHERE CAST(ts AS DATE) BETWEEN DATE '{START}' AND DATE '{END}'""",
    "scan_date_range_lines": """SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem
        WHERE CAST(l_shipdate AS DATE) BETWEEN DATE '1997-03-01' AND DATE '1997-05-31'""",
    "scan_processed_range": over(
        "processed", f"""SELECT {ROWS} FROM processed WHERE "Date" BETWEEN '{START}' AND '{END}'"""
    ),
    "scan_string_range": over(
        "cdr",
        f"""SELECT id, DP_MSISDN, t AS "DP_TS"
            FROM (SELECT *, strftime(DP_TS, '%Y-%m-%d %H:%M:%S.%f') AS t FROM cdr)
            WHERE t BETWEEN '{START}' AND '{END}'""",
    ),
    "predictions_scan": over(
        "predictions",
        """SELECT label, prediction, round(probability_0, 6) AS probability_0,
           round(probability_1, 6) AS probability_1, "Date" FROM predictions""",
    ),
    "snapshot_union": over(
        "processed",
        f"""SELECT {ROWS} FROM processed WHERE "Date" <= '2024-01-10' UNION ALL
            SELECT {ROWS} FROM processed WHERE "Date" > '2024-01-10' AND "Date" <= '2024-01-20'
            UNION ALL SELECT {ROWS} FROM processed WHERE "Date" > '2024-01-15'""",
    ),
    "csv_load_untyped": over("cdr", f"SELECT {NUMBERS} FROM cdr"),
    "csv_load_typed": over("cdr", f"SELECT {NUMBERS} FROM cdr"),
    "csv_gz_load": over("cdr", f"SELECT {NUMBERS} FROM cdr"),
    "csv_surrogate_ids": over("cdr", "SELECT count(*) AS n_rows, count(*) AS n_ids FROM cdr"),
    "csv_quoted_roundtrip": over(
        "cdr",
        f"""SELECT CAST(id AS VARCHAR) AS id, CASE id % {5 + len(MISSING_TEXTS)} WHEN 0 THEN 'x "y" z'
            WHEN 1 THEN 'a,b' WHEN 2 THEN 'line' || chr(10) || 'break' WHEN 3 THEN '"' WHEN 4 THEN 'plain'
            END AS note FROM cdr""",
    ),
    "seed_scan": over(
        "cdr",
        """SELECT least(2000, count(*)) AS n_rows, least(2000, count(*)) AS n_ids,
           least(2000, count(*)) AS n_known FROM cdr""",
    ),
    "append_roundtrip": over(
        "processed", f"SELECT {ROWS} FROM processed UNION ALL SELECT {ROWS} FROM processed"
    ),
    "snapshot_roundtrip": over("processed", f"SELECT {ROWS} FROM processed"),
    "daily_summary_table": summary("cdr", START, END),
    "load_once": over("processed", f"SELECT {ROWS} FROM processed"),
    "report_roundtrip": report("", ""),
    "json_records": over(
        "cdr",
        """SELECT id, DP_MSISDN, DP_MOC_COUNT, round(DP_MOC_DURATION, 6) AS DP_MOC_DURATION,
           DP_MOC_DURATION IS NULL AS null_kept FROM cdr""",
    ),
    "transform_cdr": over("processed", f"SELECT {ROWS} FROM processed"),
    "transform_cdr_text": over(
        "processed",
        f"""SELECT {ROWS.replace('"M_In_Call_Count"', 'nullif("M_In_Call_Count", 2) AS "M_In_Call_Count"')}
            FROM processed""",
    ),
    "transform_cdr_lines": over(
        "processed_lines", f"SELECT {cols(PROCESSED, 4)} FROM processed_lines"
    ),
    "class_filter_count": over(
        "labelled",
        """SELECT "M_Tenure_Churn", count(*) AS "count" FROM labelled
           WHERE "M_Tenure_Churn" = 0 GROUP BY 1""",
    ),
    "fill_zero": over("processed", f"SELECT {FILLED} FROM processed"),
    "nan_to_null": over("cdr", "SELECT id, round(DP_MOC_DURATION, 6) AS DP_MOC_DURATION FROM cdr"),
    "dropna_pairs": over(
        "processed",
        f"""SELECT {cols(["Date", "User", "M_Out_Call_Time", "M_Data_Sum"])} FROM processed
            WHERE "M_Out_Call_Time" IS NOT NULL AND "M_Data_Sum" IS NOT NULL""",
    ),
    "drop_all_null_cols": over("processed", f"SELECT {ROWS} FROM processed"),
    "drop_sparse_cols": over("processed", f"SELECT {FILLED} FROM processed"),
    "coerce_numeric": over(
        "cdr",
        "SELECT id::DOUBLE AS id, NULL::DOUBLE AS DP_DATE, DP_MSISDN::DOUBLE AS DP_MSISDN, "
        + ", ".join(
            rnd(
                {"DP_MTC_COUNT": "nullif(DP_MTC_COUNT, 2)", "DP_DATA_COUNT": "DP_DATA_COUNT + 0.7"}.get(
                    c, c
                )
                + "::DOUBLE",
                c,
            )
            for c in RAW_MEASURES
        ).replace("DP_DATA_COUNT + 0.7::DOUBLE", "DP_DATA_COUNT::DOUBLE + 0.7::DOUBLE")
        + ", PSEUDO_CHURNED::DOUBLE AS PSEUDO_CHURNED FROM cdr",
    ),
    "daily_summary": summary("cdr", START, END),
    "daily_summary_lines": summary("cdr_lines", "1996-01-01", "1998-12-31"),
    "recent_summary": summary("cdr", "2024-01-01", "2100-01-01").replace(
        "DATE '2024-01-01'", "(SELECT max(DP_DATE) - 7 FROM cdr)"
    ),
    "user_call_time": over(
        "processed",
        """SELECT "User", round(sum("M_Out_Call_Time"), 6) AS "M_Out_Call_Time_sum"
           FROM processed GROUP BY 1""",
    ),
    "daily_mean_data": over(
        "processed",
        'SELECT "Date", round(avg("M_Data_Sum"), 9) AS "M_Data_Sum_avg" FROM processed GROUP BY 1',
    ),
    "class_summary": over(
        "labelled", class_stats(PROCESSED[:-1], 4), source="SELECT * FROM labelled"
    ),
    "class_summary_lines": over(
        "processed_lines",
        class_stats(["M_Out_Call_Count", "M_Out_Call_Time", "M_Data_Sum"], 2),
        source="SELECT * FROM processed_lines",
    ),
    "class_counts": over(
        "labelled", 'SELECT "M_Tenure_Churn", count(*) AS "count" FROM labelled GROUP BY 1'
    ),
    "record_profile": over(
        "processed",
        """SELECT count(*) AS record_count, count(DISTINCT "User") AS distinct_subscribers
           FROM processed""",
    ),
    "subscriber_sketches": over(
        "processed",
        union(
            f"""SELECT '{name}' AS days, count(*) AS record_count, count(DISTINCT "User") AS exact_subscribers,
                true AS near FROM processed WHERE {where}"""
            for name, where in (
                ("all", "true"),
                ("middle", f""""Date" BETWEEN '{START}' AND '{END}'"""),
                ("first", """"Date" <= '2024-01-03'"""),
            )
        ),
    ),
    "null_counts": over(
        "processed",
        "SELECT " + ", ".join(f'count(*) - count("{c}") AS "{c}"' for c in PROCESSED) + " FROM processed",
    ),
    "moments": over(
        "processed",
        f"""SELECT round({centred_skew('"M_Data_Sum"', "processed", "true")}, 6) AS skewness,
            round(avg("M_Data_Sum"), 6) AS mean, round(stddev_samp("M_Data_Sum"), 6) AS stddev
            FROM processed""",
    ),
    "explore_job": exploration(),
    "sum_by_date": over(
        "cdr",
        "SELECT DP_DATE, "
        + ", ".join(
            rnd(f"coalesce(sum({c}), 0)", c)
            if c in DOUBLES
            else f"CAST(coalesce(sum({c}), 0) AS BIGINT) AS {c}"
            for c in RAW_MEASURES
        )
        + " FROM cdr WHERE DP_DATE IS NOT NULL GROUP BY 1",
    ),
    "mean_by_date": over(
        "cdr",
        "SELECT DP_DATE, "
        + ", ".join(rnd(f"avg({c})", c, 9) for c in RAW_MEASURES)
        + " FROM cdr WHERE DP_DATE IS NOT NULL GROUP BY 1",
    ),
    "describe": over("cdr", described("cdr", RAW_MEASURES, 6)),
    "describe_lines": over(
        "cdr_lines",
        described("cdr_lines", ["DP_MOC_COUNT", "DP_MOC_DURATION", "DP_DATA_VOLUME"], 6),
    ),
    "high_watermark": over("processed", 'SELECT max("Date") AS high_watermark FROM processed'),
    "distinct_dates": over(
        "cdr",
        f"""SELECT DISTINCT DP_DATE AS "Date" FROM cdr
            WHERE DP_DATE BETWEEN DATE '{START}' AND DATE '{END}'""",
    ),
    "target_correlations": over("labelled", correlations("labelled")),
    "target_correlations_lines": over("processed_lines", correlations("processed_lines")),
    "top_correlated": over(
        "labelled",
        f"""SELECT feature, correlation FROM ({correlations("labelled")})
            WHERE correlation IS NOT NULL AND NOT isnan(correlation)
            ORDER BY correlation DESC, feature LIMIT 1""",
    ),
    "r2_vs_target": over(
        "cdr",
        union(r2("source", f"{c}::DOUBLE", "PSEUDO_CHURNED", c) for c in RAW_FEATURES),
        source="SELECT * FROM cdr WHERE DP_DATE < (SELECT max(DP_DATE) FROM cdr)",
    ),
    "regression_vs_target": over(
        "cdr",
        union(
            f"""SELECT '{c}' AS feature, CAST(regr_count(PSEUDO_CHURNED, {c}) AS BIGINT) AS n,
                round(regr_slope(PSEUDO_CHURNED, {c}), 6) AS slope,
                round(regr_intercept(PSEUDO_CHURNED, {c}), 6) AS intercept,
                round(regr_r2(PSEUDO_CHURNED, {c}), 6) AS r2 FROM source"""
            for c in RAW_FEATURES
        ),
        source="SELECT * FROM cdr WHERE DP_DATE < (SELECT max(DP_DATE) FROM cdr)",
    ),
    "raw_exploration": over(
        "cdr",
        union(
            r2(
                "source",
                {
                    "DP_MTC_COUNT": "nullif(DP_MTC_COUNT, 2)::DOUBLE",
                    "DP_DATA_COUNT": "DP_DATA_COUNT::DOUBLE + 0.7::DOUBLE",
                }.get(c, f"{c}::DOUBLE"),
                "PSEUDO_CHURNED",
                c,
            )
            for c in RAW_FEATURES
        ),
        source=f"SELECT * FROM cdr WHERE DP_DATE BETWEEN DATE '{START}' AND DATE '{END}'",
    ),
    "histogram": over(
        "processed",
        """SELECT bin, round(lo + bin * w, 6) AS left_edge, round(lo + (bin + 1) * w, 6) AS right_edge,
                  coalesce(n, 0) AS "count"
           FROM spread CROSS JOIN (SELECT unnest(range(30))::INTEGER AS bin)
           LEFT JOIN (SELECT least(floor(("M_Data_Sum" - lo) / w), 29)::INTEGER AS b, count(*) AS n
                      FROM processed, spread WHERE "M_Data_Sum" IS NOT NULL GROUP BY 1) ON b = bin""",
        spread="""SELECT min("M_Data_Sum") AS lo, (max("M_Data_Sum") - min("M_Data_Sum")) / 30 AS w
                  FROM processed""",
    ),
    "kde_density": over(
        "processed",
        """SELECT point, round(any_value(place), 6) AS x,
                  round(sum(n * exp(-0.5 * ((place - x) / h) ** 2)) / any_value(total * h * sqrt(2 * pi())), 6)
                      AS density
           FROM (SELECT x, count(*) AS n FROM source GROUP BY 1),
                (SELECT point, lo + point * (hi - lo) / 199 AS place, total, std * total ** -0.2 AS h
                 FROM (SELECT unnest(range(200))::INTEGER AS point),
                      (SELECT min(x) AS lo, max(x) AS hi, count(*)::DOUBLE AS total,
                              stddev_samp(x) AS std FROM source))
           GROUP BY point""",
        source='SELECT ln(1 + "M_Data_Sum") AS x FROM processed WHERE "M_Data_Sum" > 0',
    ),
    "kde_density_binned": over(
        "processed",
        """SELECT point, round(lo + point * (hi - lo) / 199, 6) AS x,
                  round(sum(w * exp(-0.5 * u ** 2)) FILTER (reached)
                        / any_value(total * h * sqrt(2 * pi())), 6) AS density,
                  round((pow((hi - lo) / 511 / h, 2) / 8 + exp(-18)) / (h * sqrt(2 * pi())), 6) AS error_bound
           FROM (SELECT *, (lo + point * (hi - lo) / 199 - (lo + bin * (hi - lo) / 511)) / h AS u,
                        abs(lo + point * (hi - lo) / 199 - (lo + bin * (hi - lo) / 511)) <= 6 * h AS reached
                 FROM (SELECT unnest(range(200))::INTEGER AS point), shape, weights)
           GROUP BY point, lo, hi, h""",
        source='SELECT ln(1 + "M_Data_Sum") AS x FROM processed WHERE "M_Data_Sum" > 0',
        shape="""SELECT min(x) AS lo, max(x) AS hi, count(*)::DOUBLE AS total,
                        stddev_samp(x) * count(*)::DOUBLE ** -0.2 AS h FROM source""",
        placed="""SELECT (x - lo) / ((hi - lo) / 511) AS p, least(floor((x - lo) / ((hi - lo) / 511)), 510) AS b
                  FROM source, shape""",
        weights="""SELECT bin, sum(w) AS w
                   FROM (SELECT b AS bin, 1 - (p - b) AS w FROM placed UNION ALL SELECT b + 1, p - b FROM placed)
                   GROUP BY bin""",
    ),
    "log_profile": over(
        "processed",
        """SELECT count(*) AS n, round(avg(ln(1 + "M_Data_Sum")), 6) AS mean,
           round(stddev_samp(ln(1 + "M_Data_Sum")), 6) AS std
           FROM processed WHERE "M_Data_Sum" > 0""",
    ),
    "date_window_features_many_days": over(
        "processed",
        f"SELECT {ROWS}, {stat_cols(STAT_COLUMNS, 9)} FROM stats",
        stats=date_stats(STAT_COLUMNS, "processed"),
    ),
    "date_window_features": over(
        "processed",
        f"SELECT {ROWS}, {stat_cols(STAT_COLUMNS, 9)} FROM stats",
        stats=date_stats(STAT_COLUMNS, "processed"),
    ),
    "date_window_features_lines": over(
        "processed_lines",
        f"""SELECT "Date", "M_Out_Call_Count", "M_Data_Count",
            {stat_cols(["M_Out_Call_Count", "M_Data_Count"])} FROM stats""",
        stats=date_stats(["M_Out_Call_Count", "M_Data_Count"], "processed_lines"),
    ),
    "log_features": over(
        "processed",
        f"SELECT {ROWS}, {', '.join(rnd(log1p(c), f'{c}_log') for c in STAT_COLUMNS)} FROM processed",
    ),
    "feature_table": features("labelled", False),
    "feature_table_filled_first": features("labelled", True),
    "min_max_scale": over(
        "labelled",
        f"SELECT {ROWS}, "
        + ", ".join(
            f"""round(("{c}" - min("{c}") OVER ())
                / nullif(max("{c}") OVER () - min("{c}") OVER (), 0)::DOUBLE, 6) AS "scaled_{c}\""""
            for c in ("M_Tenure_Churn", "M_Data_Sum", "M_Data_Count")
        )
        + " FROM labelled",
    ),
    "reflect_transform": over(
        "processed",
        """SELECT round(s, 6) AS "scaled_M_Data_Sum", round(r, 6) AS reflected,
                  round(1 / nullif(ln(r), 0), 6) AS adjusted
           FROM (SELECT s, max(s) OVER () + 1 - s AS r FROM scaled)""",
        scaled="""SELECT ("M_Data_Sum" - min("M_Data_Sum") OVER ())
                  / nullif(max("M_Data_Sum") OVER () - min("M_Data_Sum") OVER (), 0) AS s
                  FROM processed""",
    ),
    "latest_100": over(
        "cdr",
        """SELECT id, strftime(DP_TS, '%Y-%m-%d %H:%M:%S.%f') AS "DP_TS", DP_MSISDN,
           round(DP_MOC_DURATION, 6) AS DP_MOC_DURATION
           FROM cdr ORDER BY cdr.DP_TS DESC, id DESC LIMIT 100""",
    ),
    "sample_n": over(
        "cdr",
        """SELECT least(200, count(*)) AS n_rows, least(200, count(*)) AS n_ids,
           least(200, count(*)) AS n_known FROM cdr""",
    ),
    "churn_predictions": over(
        "labelled",
        """SELECT "Date", "User", "M_Tenure_Churn" AS label, true AS sums_to_one, true AS is_share,
                  true AS agrees, 4 AS grid_points, 3 AS folds
           FROM labelled WHERE ("User"::BIGINT * 31 + day("Date"::DATE)) % 10 >= 8""",
    ),
    "run_job": over(
        "processed",
        f"""SELECT count(*) AS prepared_rows, true AS rows_known, true AS auc_is_share
            FROM processed WHERE "Date" BETWEEN '{START}' AND '{END}'""",
    ),
    "train_job": over(
        "processed",
        """SELECT count(*) AS table_rows, count(DISTINCT "Date") AS days, true AS rows_known,
           true AS auc_is_share FROM processed""",
    ),
    "oversample": over(
        "labelled",
        f"""SELECT "Date", "User", "M_Tenure_Churn" AS label, CASE WHEN "M_Tenure_Churn" = 0 THEN 1
                   ELSE len(list_filter({poisson_steps(20.0)}, lambda step: step <= u)) END AS copies
            FROM (SELECT *, ('0x' || substr(md5('42|' || "Date" || '|' || "User"), 1, 13))::BIGINT::DOUBLE
                            / 4503599627370496::DOUBLE AS u FROM labelled)
            WHERE "M_Tenure_Churn" = 0
                  OR len(list_filter({poisson_steps(20.0)}, lambda step: step <= u)) > 0""",
    ),
    "oversample_random": over(
        "labelled",
        """SELECT "M_Tenure_Churn" AS label, count(*) AS source_rows, true AS near_factor
           FROM labelled GROUP BY 1""",
    ),
    "oversample_exact": over(
        "labelled",
        """SELECT "Date", "User", "M_Tenure_Churn",
           unnest(range(1, CASE WHEN "M_Tenure_Churn" = 1 THEN 21 ELSE 2 END))::INTEGER AS "copy"
           FROM labelled""",
    ),
    "random_split": over(
        "cdr", "SELECT count(*) AS n_rows, count(DISTINCT id) AS n_ids, true AS near_share FROM cdr"
    ),
    "key_split": over(
        "cdr",
        """SELECT id, DP_MSISDN, CASE WHEN id % 10 < 8 THEN 'train' ELSE 'test' END AS part
           FROM cdr""",
    ),
    "auc_hard": over(
        "predictions",
        """SELECT round((avg((prediction = 1)::INTEGER) FILTER (label = 1)
           + avg((prediction = 0)::INTEGER) FILTER (label = 0)) / 2, 6) AS auc_hard
           FROM predictions""",
    ),
    "predictions_flat": over(
        "predictions",
        f"""SELECT {PREDICTION_ROWS}, round(probability_0 * 10, 6) AS "rawPrediction_0",
            round(probability_1 * 10, 6) AS "rawPrediction_1",
            label || '.0,' || prediction::INTEGER || '.0' AS features_str FROM predictions""",
    ),
    "single_class_guard": over(
        "predictions",
        """SELECT name AS "input", coalesce(min(label) <> max(label), false) AS both_classes,
                  0::BIGINT AS report_rows
           FROM (SELECT label, 'both' AS name FROM predictions
                 UNION ALL SELECT label, 'one' FROM predictions WHERE label = 0) GROUP BY name""",
    ),
    "chunk_by_count": over(
        "predictions",
        """SELECT "Date", "User", CAST(ntile(10) OVER (ORDER BY "Date", "User") AS INTEGER) AS chunk
           FROM predictions""",
    ),
    "chunk_by_count_copies": over(
        "predictions",
        """SELECT chunk, count(*) AS n, min("Date") AS start_date, max("Date") AS end_date,
                  sum(prediction) AS predicted
           FROM (SELECT "Date", prediction, CAST(ntile(10) OVER (ORDER BY "Date", prediction) AS INTEGER)
                 AS chunk FROM predictions) GROUP BY chunk""",
    ),
    "monitoring_job_by_count": report("", "", BY_COUNT),
    "chunk_by_count_lines": """
        SELECT chunk, min(day) AS start_date, max(day) AS end_date,
               CAST(sum(l_orderkey) AS BIGINT) AS order_keys
        FROM (SELECT l_orderkey, CAST(l_shipdate AS DATE) AS day, CAST(ntile(10) OVER (
                  ORDER BY l_shipdate, l_orderkey, l_linenumber) AS INTEGER) AS chunk FROM lineitem)
        GROUP BY chunk""",
    "chunk_metrics": over(
        "predictions", f"SELECT {METRIC_COLS} FROM measured", by_day=BY_DAY, measured=metrics("by_day")
    ),
    "chunk_metrics_lines": f"""
        WITH source AS (
            SELECT l_linestatus AS chunk, CAST(l_shipdate AS DATE) AS day,
                   CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS label,
                   CASE WHEN l_extendedprice >= 40000 THEN 1 ELSE 0 END AS prediction,
                   l_extendedprice AS score FROM lineitem),
        measured AS ({metrics("source")})
        SELECT {METRIC_COLS} FROM measured""",
    "monitor_report": report("", ""),
    "monitor_reference": report(
        "WHERE chunk >= DATE '2024-01-13'", "WHERE chunk < DATE '2024-01-13'"
    ),
    "new_since": over(
        "predictions",
        """SELECT mark, coalesce(high > since, true) AS has_new, high AS high_watermark
            FROM (SELECT max("Date") AS high FROM predictions),
                 (SELECT 'first' AS mark, NULL AS since UNION ALL SELECT 'middle', '2024-01-12'
                  UNION ALL SELECT 'latest', max("Date") FROM predictions)""",
    ),
    "rows_since": over(
        "predictions", f"""SELECT {PREDICTION_ROWS} FROM predictions WHERE "Date" > '2024-01-20'"""
    ),
    "augment_batch": over(
        "cdr",
        """SELECT least(200, count(*)) AS n_rows, true AS near_now, false AS has_id,
           true AS near_mean, true AS near_deviation FROM cdr""",
    ),
    "stream_ingest": over("processed", f"SELECT {ROWS} FROM processed"),
    "stream_daily_totals": summary("cdr", "2024-01-01", "2024-12-31"),
    "stream_daily_late": summary("cdr", "2024-01-01", "2024-12-31"),
    "stream_monitor": report("", ""),
    "stream_monitor_single_class": over(
        "predictions",
        """SELECT count(DISTINCT "Date") AS days, count(*) AS "rows", 0 AS report_rows
           FROM predictions WHERE label = 0""",
    ),
    "prepared_table_rerun": over(
        "processed",
        f"""SELECT {ROWS} FROM processed
            WHERE "Date" BETWEEN '{START}' AND '{END}' AND "Date" <> '2024-01-12'""",
    ),
    "prepared_table": over(
        "processed", f"""SELECT {ROWS} FROM processed WHERE "Date" BETWEEN '{START}' AND '{END}'"""
    ),
}
