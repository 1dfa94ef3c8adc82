"""DuckDB statements that compute the registered queries a second way.

Shared steps are named once and put in front of a query as CTEs, in the order
they depend on each other.
"""

from __future__ import annotations

from lendwatch.functions.labels import (
    BAND_LABELS,
    CLIENT_SIZE_LABELS,
    CLIENT_TYPE_LABELS,
    MODALITY_LABELS,
)
from lendwatch.schema import AMOUNT_COLUMNS, COUNT_COLUMN, TEXT_COLUMNS

STEPS = {
    "stg": """
        SELECT last_day(CAST(l_shipdate AS DATE)) AS reference_date,
               r_name AS state,
               o_orderstatus AS institution_segment,
               CASE WHEN c_mktsegment IN ('FURNITURE', 'HOUSEHOLD') THEN 'PF' ELSE 'PJ' END
                   AS client_type,
               CASE sn.n_name WHEN 'NATION_0' THEN '' WHEN 'NATION_1' THEN 'Outros'
                   ELSE sn.n_name END AS economic_activity,
               o_orderpriority AS client_size,
               p_type AS credit_modality,
               p_brand AS credit_submodality,
               CAST(l_quantity AS BIGINT) AS number_of_operations,
               active - (price * l_tax + bad) AS outstanding_balance,
               price * l_tax + bad AS overdue_balance,
               price * l_tax AS overdue_15_to_90_balance,
               bad AS overdue_over_90_balance,
               active AS active_portfolio,
               bad AS default_portfolio,
               bad * 1.1::DOUBLE AS problem_assets
        FROM (SELECT *, l_extendedprice AS price,
                     CASE WHEN l_quantity = 1 THEN 0.0::DOUBLE ELSE l_extendedprice END AS active,
                     CASE WHEN l_quantity = 1 THEN 0.0::DOUBLE
                          ELSE l_extendedprice * l_discount END AS bad
              FROM lineitem)
        JOIN orders ON l_orderkey = o_orderkey
        JOIN customer ON o_custkey = c_custkey
        JOIN nation cn ON c_nationkey = cn.n_nationkey
        JOIN region ON cn.n_regionkey = r_regionkey
        JOIN part ON l_partkey = p_partkey
        JOIN supplier ON l_suppkey = s_suppkey
        JOIN nation sn ON s_nationkey = sn.n_nationkey""",
    "daily": """
        SELECT CAST(o_orderdate AS DATE) AS day, round(avg(o_totalprice) / 10000, 2) AS value
        FROM orders GROUP BY ALL""",
    "rates": """
        SELECT last_day(day) AS reference_date,
               arg_max(value, day) AS selic_target_rate_annual
        FROM daily GROUP BY ALL""",
    "dim_modality": """
        SELECT CAST(row_number() OVER (ORDER BY credit_modality NULLS FIRST,
                   credit_submodality NULLS FIRST) AS BIGINT) AS modality_id, *
        FROM (SELECT DISTINCT credit_modality, credit_submodality FROM stg)""",
    "dim_client": """
        SELECT CAST(row_number() OVER (ORDER BY client_type NULLS FIRST,
                   client_size NULLS FIRST) AS BIGINT) AS client_id, *
        FROM (SELECT DISTINCT client_type, client_size FROM stg)""",
    "dim_activity": """
        SELECT CAST(row_number() OVER (ORDER BY economic_activity) AS BIGINT)
                   AS economic_activity_id, *
        FROM (SELECT DISTINCT economic_activity FROM stg WHERE economic_activity <> '')""",
    "fact": """
        SELECT stg.*, modality_id, client_id, economic_activity_id,
               default_portfolio / nullif(active_portfolio, 0) AS default_rate
        FROM stg
        LEFT JOIN dim_modality USING (credit_modality, credit_submodality)
        LEFT JOIN dim_client USING (client_type, client_size)
        LEFT JOIN dim_activity USING (economic_activity)""",
    "by_sector": """
        SELECT reference_date, economic_activity AS sector,
               sum(active_portfolio) AS a, sum(default_portfolio) AS d,
               CAST(sum(number_of_operations) AS BIGINT) AS number_of_operations
        FROM stg WHERE economic_activity <> '' GROUP BY ALL""",
    "panel": """
        SELECT CAST(date_trunc('month', reference_date) AS DATE) AS month_start,
               state, credit_modality, client_type, client_size,
               sum(active_portfolio) AS active_portfolio,
               sum(default_portfolio) AS default_portfolio,
               sum(overdue_15_to_90_balance) AS overdue_15_to_90_balance,
               CAST(sum(number_of_operations) AS BIGINT) AS number_of_operations
        FROM stg GROUP BY ALL""",
    "base": """
        SELECT *, concat_ws(' | ', state, credit_modality, client_type, client_size) AS sid,
               year(month_start) * 12 + month(month_start) AS mi,
               default_portfolio / active_portfolio AS dr,
               overdue_15_to_90_balance / active_portfolio AS er
        FROM panel WHERE active_portfolio > 0""",
    "monthly_rate": """
        SELECT year(reference_date) * 12 + month(reference_date) AS mi,
               avg(selic_target_rate_annual) AS r
        FROM rates GROUP BY ALL""",
    "features": """
        SELECT b.sid AS segment_id, b.month_start AS reference_month,
               b.state, b.credit_modality, b.client_type, b.client_size, b.active_portfolio,
               b.dr AS default_rate, b.er AS early_delinquency_rate,
               b.dr - q.dr AS default_rate_chg_3m,
               b.dr - h.dr AS default_rate_chg_6m,
               b.er - q.er AS early_delinquency_chg_3m,
               b.active_portfolio / h.active_portfolio - 1 AS portfolio_growth_6m,
               b.active_portfolio / nullif(b.number_of_operations, 0)
                   AS avg_balance_per_operation,
               log10(b.active_portfolio) AS log_active_portfolio,
               now.r AS selic_rate,
               now.r - ago.r AS selic_chg_6m,
               nxt.dr AS default_rate_forward,
               CAST(CASE WHEN nxt.dr IS NOT NULL THEN
                   (nxt.dr - b.dr >= 0.005::DOUBLE AND nxt.dr >= b.dr * 1.15::DOUBLE)::INTEGER
               END AS INTEGER) AS target_deterioration
        FROM base b
        JOIN base h ON h.sid = b.sid AND h.mi + 6 = b.mi
        LEFT JOIN base q ON q.sid = b.sid AND q.mi + 3 = b.mi
        LEFT JOIN base nxt ON nxt.sid = b.sid AND nxt.mi - 6 = b.mi
        LEFT JOIN monthly_rate now ON now.mi = b.mi
        LEFT JOIN monthly_rate ago ON ago.mi + 6 = b.mi
        WHERE b.active_portfolio >= 50000 AND h.dr IS NOT NULL""",
    "scored": "SELECT *, round(early_delinquency_rate, 4) AS score FROM features",
    "lab": "SELECT * FROM scored WHERE target_deterioration IS NOT NULL",
    "bounds": """
        SELECT min(reference_month) AS test_start,
               CAST(min(reference_month) - INTERVAL 6 MONTH AS DATE) AS train_limit
        FROM (SELECT DISTINCT reference_month FROM lab ORDER BY 1 DESC LIMIT 6)""",
    "cuts": """
        SELECT quantile_cont(score, 0.7) AS medium_cut, quantile_cont(score, 0.9) AS high_cut
        FROM lab, bounds WHERE reference_month >= test_start""",
    "latest": """
        SELECT * FROM scored
        WHERE reference_month = (SELECT max(reference_month) FROM scored)""",
    "scores": """
        SELECT latest.*, CASE WHEN score >= high_cut THEN 'Alto'
                              WHEN score >= medium_cut THEN 'Médio' ELSE 'Baixo' END AS risk_band
        FROM latest, cuts""",
}

NEEDS = {
    "rates": ["daily"],
    "dim_modality": ["stg"],
    "dim_client": ["stg"],
    "dim_activity": ["stg"],
    "fact": ["dim_modality", "dim_client", "dim_activity"],
    "by_sector": ["stg"],
    "panel": ["stg"],
    "base": ["panel"],
    "monthly_rate": ["rates"],
    "features": ["base", "monthly_rate"],
    "scored": ["features"],
    "lab": ["scored"],
    "bounds": ["lab"],
    "cuts": ["bounds"],
    "latest": ["scored"],
    "scores": ["latest", "cuts"],
}


def _with(steps: list[str], body: str) -> str:
    wanted: set[str] = set()

    def add(step: str) -> None:
        wanted.add(step)
        for earlier in NEEDS.get(step, []):
            add(earlier)

    for step in steps:
        add(step)
    ctes = ",\n".join(f"{name} AS ({STEPS[name]})" for name in STEPS if name in wanted)
    return f"WITH {ctes}\n{body}" if ctes else body


def _round(columns: str, places: int) -> str:
    return ", ".join(f"round({c}, {places}) AS {c}" for c in columns.split())


def _report(keys: str) -> str:
    return f"""
        SELECT reference_date, CAST(year(reference_date) AS BIGINT) AS year,
               CAST(month(reference_date) AS BIGINT) AS month, {keys}, selic_target_rate_annual,
               round(a, 4) AS active_portfolio_total, round(d, 4) AS default_portfolio_total,
               round(d / nullif(a, 0), 6) AS default_rate, number_of_operations"""


def _totals(keys: str, where: str = "true") -> str:
    return f"""(SELECT reference_date, {keys}, sum(active_portfolio) AS a,
                       sum(default_portfolio) AS d,
                       CAST(sum(number_of_operations) AS BIGINT) AS number_of_operations
                FROM stg WHERE {where} GROUP BY ALL)"""


FEATURE_COLUMNS = f"""
    segment_id, reference_month, state, credit_modality, client_type, client_size,
    {_round("active_portfolio", 4)},
    CAST(CAST(avg_balance_per_operation AS FLOAT) AS DOUBLE) AS avg_balance_per_operation,
    {_round("default_rate early_delinquency_rate default_rate_chg_3m default_rate_chg_6m", 6)},
    {_round("early_delinquency_chg_3m portfolio_growth_6m log_active_portfolio", 6)},
    {_round("selic_rate selic_chg_6m default_rate_forward", 6)}, target_deterioration"""

SCORE_COLUMNS = """reference_month, segment_id, state, credit_modality, client_type, client_size,
    active_portfolio, default_rate, early_delinquency_rate, score, risk_band"""

FEATURE_NAMES = """default_rate early_delinquency_rate default_rate_chg_3m default_rate_chg_6m
    early_delinquency_chg_3m portfolio_growth_6m avg_balance_per_operation log_active_portfolio
    selic_rate selic_chg_6m""".split()


def _label(column: str, labels: list[tuple[str, str]]) -> str:
    whens = " ".join(f"WHEN {column} LIKE '{value}' THEN '{label}'" for value, label in labels)
    return f"CASE {whens} ELSE {column} END"


BAND_EN = _label("risk_band", BAND_LABELS)
TYPE_EN = _label("client_type", CLIENT_TYPE_LABELS)
SIZE_EN = _label("client_size", CLIENT_SIZE_LABELS)
MODALITY_EN = _label("credit_modality", MODALITY_LABELS)

HIGH = """count(*) FILTER (risk_band = 'Alto') AS high_risk_segments,
    round(sum(CASE WHEN risk_band = 'Alto' THEN active_portfolio ELSE 0 END), 4)
        AS high_risk_portfolio"""
HIGH_SHARE = """round(sum(CASE WHEN risk_band = 'Alto' THEN active_portfolio ELSE 0 END)
    / sum(active_portfolio), 6) AS high_risk_share"""

FILE = "strftime(last_day(CAST(l_shipdate AS DATE)), 'scrdata_%Y%m.csv')"
SHIP_END = "last_day(CAST(l_shipdate AS DATE))"
LOADS = f"""SELECT {FILE} AS file, count(*) AS n_rows, min({SHIP_END}) AS first_day,
    max({SHIP_END}) AS last_day FROM lineitem WHERE {{where}} GROUP BY ALL"""

UNUSED = """0.0::DOUBLE AS a_vencer_ate_90_dias, 0.0::DOUBLE AS a_vencer_de_91_ate_360_dias,
    0.0::DOUBLE AS a_vencer_de_361_ate_1080_dias, 0.0::DOUBLE AS a_vencer_de_1081_ate_1800_dias,
    0.0::DOUBLE AS a_vencer_de_1801_ate_5400_dias, 0.0::DOUBLE AS a_vencer_acima_de_5400_dias"""


def _metrics() -> str:
    return _with(
        ["lab"],
        """, per AS (SELECT score, sum(target_deterioration) AS pos,
                      sum(1 - target_deterioration) AS neg FROM lab GROUP BY score),
        run AS (SELECT *, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp,
                       sum(pos) OVER () AS p, sum(neg) OVER () AS n
                FROM per WINDOW w AS (ORDER BY score DESC)),
        out AS (SELECT sum(neg::DOUBLE * (tp - pos / 2.0::DOUBLE)) / max(p::DOUBLE * n) AS auc,
                       max(abs(tp::DOUBLE / p - fp::DOUBLE / n)) AS ks,
                       sum((pos::DOUBLE / p) * (tp::DOUBLE / (tp + fp))) AS ap FROM run)
        SELECT round(auc, 6) AS auc, round(2 * auc - 1, 6) AS gini, round(ks, 6) AS ks,
               round(ap, 6) AS ap FROM out""",
    )


def _check(check: str, target: str, failures: str) -> str:
    return f"""SELECT '{check}' AS "check", '{target}' AS target,
        CAST(f AS BIGINT) AS failures, CASE WHEN f > 0 THEN 'error' ELSE 'pass' END AS status
        FROM (SELECT coalesce(({failures}), 0) AS f)"""


def _all_checks() -> str:
    parts = []
    for table, dim, key in (
        ("dim_credit_modality", "dim_modality", "modality_id"),
        ("dim_client", "dim_client", "client_id"),
        ("dim_economic_activity", "dim_activity", "economic_activity_id"),
    ):
        nulls = f"SELECT count(*) FROM {dim} WHERE {key} IS NULL"
        repeats = f"SELECT count({key}) - count(DISTINCT {key}) FROM {dim}"
        parts.append(_check("not_null", f"{table}.{key}", nulls))
        parts.append(_check("unique", f"{table}.{key}", repeats))
    fact = "fact_credit_operation"
    for column in ("modality_id", "client_id", "active_portfolio"):
        nulls = f"SELECT count(*) - count({column}) FROM fact"
        parts.append(_check("not_null", f"{fact}.{column}", nulls))
    low = "SELECT count(*) FROM {} WHERE {} < 0"
    parts.append(
        _check("accepted_range", f"{fact}.active_portfolio", low.format("fact", "active_portfolio"))
    )
    for dim, key in (("dim_modality", "modality_id"), ("dim_client", "client_id")):
        orphans = f"SELECT count(*) FROM fact WHERE {key} NOT IN (SELECT {key} FROM {dim})"
        parts.append(_check("relationships", f"{fact}.{key}", orphans))
    repeated = "SELECT count(*) FROM (SELECT 1 FROM {0} GROUP BY {1} HAVING count(*) > 1)"
    grain = "month_start+state+credit_modality+client_type+client_size"
    combo = "unique_combination_of_columns"
    parts += [
        _check(combo, f"ew_segment_month.{grain}", repeated.format("panel", grain.replace("+", ","))),
        _check(
            "not_null",
            "ew_segment_month.active_portfolio",
            "SELECT count(*) - count(active_portfolio) FROM panel",
        ),
        _check(
            "accepted_range",
            "ew_segment_month.active_portfolio",
            low.format("panel", "active_portfolio"),
        ),
        _check(
            combo,
            "ew_features.segment_id+reference_month",
            repeated.format("features", "segment_id, reference_month"),
        ),
        _check(
            "not_null",
            "ew_features.segment_id",
            "SELECT count(*) - count(segment_id) FROM features",
        ),
        _check(
            "not_null",
            "ew_features.default_rate",
            "SELECT count(*) - count(default_rate) FROM features",
        ),
        _check("accepted_range", "ew_features.default_rate", low.format("features", "default_rate")),
        _check(
            "accepted_values",
            "ew_features.target_deterioration",
            "SELECT count(*) FROM features WHERE target_deterioration NOT IN (0, 1)",
        ),
    ]
    return "\nUNION ALL\n".join(parts)


def _unique_combos() -> str:
    repeated = "SELECT count(*) FROM (SELECT 1 FROM features GROUP BY {} HAVING count(*) > 1)"
    combo = "unique_combination_of_columns"
    return "\nUNION ALL\n".join(
        _check(name, f"ew_features.{'+'.join(cols)}", repeated.format(", ".join(cols)))
        for name, cols in (
            (combo, ["segment_id", "reference_month"]),
            (combo, ["state", "reference_month"]),
            ("unique", ["reference_month"]),
        )
    )


def _freshness() -> str:
    return "\nUNION ALL\n".join(
        f"""SELECT 'freshness' AS "check", 'stg@{day}.reference_date' AS target,
            CAST(age AS BIGINT) AS failures,
            CASE WHEN age <= 60 THEN 'pass' WHEN age <= 90 THEN 'warn' ELSE 'error' END AS status
            FROM (SELECT date_diff('day', max({SHIP_END}), DATE '{day}') AS age FROM lineitem)"""
        for day in ("2001-12-15", "2002-02-15", "2002-06-01")
    )


def _sample(values: list[str], index: str) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + f"][({index}) + 1]"


def _label_case() -> str:
    from lendwatch.queries import _SAMPLE_MODALITIES, _SAMPLE_SIZES

    types, bands = ["PF", "PJ", "XX"], ["Alto", "Médio", "Baixo", "Nulo"]
    return f"""
        WITH raw AS (
            SELECT {_sample(_SAMPLE_MODALITIES, "l_partkey % 7")} AS credit_modality,
                   {_sample(types, "l_partkey % 3")} AS client_type,
                   {_sample(_SAMPLE_SIZES, "l_suppkey % 6")} AS client_size,
                   {_sample(bands, "l_suppkey % 4")} AS risk_band
            FROM lineitem)
        SELECT {MODALITY_EN} AS credit_modality, {TYPE_EN} AS client_type,
               {SIZE_EN} AS client_size, {BAND_EN} AS risk_band,
               CASE credit_modality WHEN 'Outros' THEN 'Other / unclassified activity'
                   ELSE credit_modality END AS sector,
               CASE client_type WHEN 'XX' THEN 'NA' ELSE client_type END || ' | ' || client_size
                   AS segment_id,
               count(*) AS n_rows
        FROM raw GROUP BY ALL"""


def statements() -> dict[str, str]:
    q: dict[str, str] = {}

    q["raw_line_scan"] = f"""SELECT {FILE} AS file, count(*) + 1 AS n_lines,
        CAST(1 AS BIGINT) AS n_headers FROM lineitem GROUP BY ALL"""
    q["raw_header_filter"] = f"""SELECT {FILE} AS file, count(*) AS n_lines FROM lineitem
        WHERE l_quantity NOT IN (9, 10) GROUP BY ALL"""
    q["csv_parse_typed"] = _with(
        ["stg"],
        f"""SELECT reference_date AS data_base, state AS uf, institution_segment AS segmento,
            client_type AS cliente, economic_activity AS cnae_ocupacao, client_size AS porte,
            credit_modality AS modalidade, credit_submodality AS submodalidade,
            '0' AS origem, '0' AS indexador, number_of_operations AS numero_de_operacoes,
            {UNUSED}, round(outstanding_balance, 6) AS carteira_a_vencer,
            round(overdue_15_to_90_balance, 6) AS vencido_de_15_ate_90_dias,
            round(overdue_over_90_balance, 6) AS vencido_acima_de_90_dias,
            round(overdue_balance, 6) AS carteira_vencida,
            round(active_portfolio, 6) AS carteira_ativa,
            round(default_portfolio, 6) AS carteira_inadimplencia,
            round(problem_assets, 6) AS ativo_problematico,
            strftime(reference_date, 'scrdata_%Y%m.csv') AS source_file FROM stg""",
    )
    texts = ["data_base", *TEXT_COLUMNS, COUNT_COLUMN, "source_file"]
    content = [f"coalesce(CAST({c} AS VARCHAR), '')" for c in texts]
    content += [f"coalesce(CAST(CAST(round({c} * 100) AS BIGINT) AS VARCHAR), '')" for c in AMOUNT_COLUMNS]
    q["sample_preview"] = f"""SELECT * FROM ({q["csv_parse_typed"]})
        ORDER BY md5(concat_ws('|', '7', {", ".join(content)})) LIMIT 5"""
    q["csv_quarantine_counts"] = """
        WITH marked AS (
            SELECT CASE WHEN l_quantity IN (2, 3, 8) THEN 'field_count'
                        WHEN l_quantity = 5 THEN 'bad_date'
                        WHEN l_quantity IN (6, 7) THEN 'bad_count'
                        WHEN l_quantity IN (4, 17, 20, 21) THEN 'bad_number'
                        ELSE 'ok' END AS outcome, *
            FROM lineitem WHERE l_quantity NOT IN (9, 10))
        SELECT outcome, count(*) AS n_rows,
               round(sum(CASE WHEN outcome <> 'ok' THEN NULL
                              WHEN l_quantity IN (1, 14, 15, 16) THEN 0.0::DOUBLE
                              ELSE l_extendedprice END), 4) AS active,
               CAST(sum(CASE WHEN outcome = 'ok' THEN
                   CASE WHEN l_quantity = 19 THEN 0 ELSE CAST(l_quantity AS BIGINT) END END)
                   AS BIGINT) AS operations,
               count(*) FILTER (l_quantity = 13) AS n_unquoted
        FROM marked GROUP BY ALL"""
    q["parse_br_number"] = """
        SELECT CAST(l_quantity AS INTEGER) AS variant, count(*) AS n_rows,
               count(*) FILTER (l_quantity IN (5, 6, 7, 8, 9, 12, 13, 17, 18)) AS n_rejected,
               round(sum(CASE WHEN l_quantity <= 4 THEN 0.0::DOUBLE
                        WHEN l_quantity IN (5, 6, 7, 8, 9, 12, 13, 17, 18) THEN NULL
                        WHEN l_quantity = 10 THEN 1500.0::DOUBLE
                        WHEN l_quantity = 11 THEN 1000.0::DOUBLE
                        WHEN l_quantity = 14 THEN -l_extendedprice
                        WHEN l_quantity = 16 THEN 0.5::DOUBLE
                        ELSE l_extendedprice END), 4) AS total
        FROM lineitem GROUP BY ALL"""
    q["parse_reference_date"] = """
        WITH t AS (SELECT CAST(l_quantity AS INTEGER) AS variant,
                          CAST(l_shipdate AS DATE) AS day FROM lineitem),
        p AS (SELECT variant,
                     CASE WHEN variant = 1 THEN CAST(date_trunc('month', day) AS DATE)
                          WHEN variant IN (4, 5, 6, 7, 8, 9) THEN NULL ELSE day END AS lenient,
                     variant > 9 OR variant = 3 AS is_iso FROM t)
        SELECT variant, count(*) AS n_rows, count(lenient) AS n_lenient,
               count(*) FILTER (is_iso) AS n_strict, min(lenient) AS first_day,
               max(lenient) AS last_day FROM p GROUP BY ALL"""
    q["parse_operation_count"] = """
        SELECT CAST(l_quantity AS INTEGER) AS variant, count(*) AS n_rows,
               count(*) FILTER (l_quantity IN (2, 3, 8, 9, 10)) AS n_rejected,
               CAST(sum(CASE WHEN l_quantity = 1 THEN 0
                        WHEN l_quantity IN (2, 3, 8, 9, 10) THEN NULL
                        WHEN l_quantity = 5 THEN -l_partkey
                        WHEN l_quantity = 7 THEN 1000 ELSE l_partkey END) AS BIGINT) AS total
        FROM lineitem GROUP BY ALL"""
    every_load = LOADS.format(where="true")
    q["rows_per_source_file"] = every_load
    q["append_idempotent"] = every_load
    q["incremental_stream_load"] = every_load
    q["year_pruned_scan"] = LOADS.format(where="year(l_shipdate) IN (1996, 1997)")
    q["incremental_new_files"] = f"""SELECT DISTINCT {FILE} AS source_file,
        {FILE} = 'scrdata_200012.csv' AS is_target FROM lineitem
        WHERE l_shipdate >= DATE '2000-01-01'"""
    q["rate_json_parse"] = _with(["daily"], "SELECT * FROM daily")
    q["history_replace_month"] = _with(
        ["scored"],
        """SELECT reference_month, count(*) AS n_rows,
            round(sum(score * CASE WHEN reference_month >= DATE '2000-01-01' THEN 2 ELSE 1 END), 4)
                AS score_total FROM scored GROUP BY ALL""",
    )
    q["fact_partition_pruned"] = _with(
        ["stg"],
        """SELECT reference_date, state, count(*) AS n_rows,
            round(sum(active_portfolio), 4) AS active_portfolio
            FROM stg WHERE year(reference_date) = 1998 GROUP BY ALL""",
    )

    amounts = """outstanding_balance overdue_balance overdue_15_to_90_balance
        overdue_over_90_balance active_portfolio default_portfolio problem_assets"""
    q["stg_projection"] = _with(
        ["stg"],
        f"""SELECT reference_date, state, institution_segment, client_type, economic_activity,
            client_size, credit_modality, credit_submodality, number_of_operations,
            {_round(amounts, 6)} FROM stg""",
    )
    q["dim_date"] = f"""SELECT d AS reference_date, CAST(year(d) AS BIGINT) AS year,
        CAST(month(d) AS BIGINT) AS month, CAST(quarter(d) AS BIGINT) AS quarter
        FROM (SELECT DISTINCT {SHIP_END} AS d FROM lineitem)"""
    q["dim_state"] = _with(["stg"], "SELECT DISTINCT state FROM stg WHERE state <> ''")
    q["dim_client"] = _with(["dim_client"], "SELECT * FROM dim_client")
    q["dim_credit_modality"] = _with(["dim_modality"], "SELECT * FROM dim_modality")
    q["dim_economic_activity"] = _with(["dim_activity"], "SELECT * FROM dim_activity")
    q["dim_rate"] = _with(["rates"], "SELECT * FROM rates")
    q["fact_credit_operation"] = _with(
        ["fact"],
        f"""SELECT reference_date, state, modality_id, institution_segment, client_id,
            economic_activity_id, number_of_operations, {_round(amounts, 6)},
            round(default_rate, 6) AS default_rate FROM fact""",
    )
    q["rpt_state_default_by_month"] = _with(
        ["stg", "rates"],
        f"""{_report("state")} FROM {_totals("state")} t LEFT JOIN
            (SELECT reference_date AS month_end, selic_target_rate_annual FROM rates)
            ON last_day(t.reference_date) = month_end""",
    )
    q["rpt_sector_default_by_month"] = _with(
        ["by_sector", "rates"],
        f"{_report('sector')} FROM by_sector LEFT JOIN rates USING (reference_date)",
    )
    q["rpt_top_sector_default_by_month"] = _with(
        ["by_sector", "rates"],
        f"""{_report("sector")} FROM by_sector LEFT JOIN rates USING (reference_date)
            WHERE sector IN (SELECT sector FROM by_sector GROUP BY sector
                             ORDER BY sum(a) DESC, sector LIMIT 8)""",
    )
    renamed = """CASE economic_activity WHEN 'Outros' THEN 'Other / unclassified activity'
        ELSE economic_activity END AS sector"""
    q["rpt_credit_by_state_sector_month"] = _with(
        ["stg", "rates"],
        f"""{_report("state, sector")}
            FROM {_totals("state, " + renamed, "economic_activity <> ''")} t LEFT JOIN
            (SELECT reference_date AS month_end, selic_target_rate_annual FROM rates)
            ON last_day(t.reference_date) = month_end""",
    )
    q["rate_month_end"] = _with(
        ["rates"],
        """SELECT reference_date AS data_base, selic_target_rate_annual AS selic_meta_aa
            FROM rates""",
    )
    q["rate_by_month"] = _with(
        ["rates"],
        """SELECT CAST(date_trunc('month', reference_date) AS DATE) AS month_start,
            round(avg(selic_target_rate_annual), 6) AS selic_rate FROM rates GROUP BY ALL""",
    )

    q["ew_segment_month"] = _with(
        ["panel"],
        f"""SELECT month_start, state, credit_modality, client_type, client_size,
            {_round("active_portfolio default_portfolio overdue_15_to_90_balance", 4)},
            number_of_operations FROM panel""",
    )
    q["ew_features"] = _with(["features"], f"SELECT {FEATURE_COLUMNS} FROM features")
    q["ew_labelled"] = _with(
        ["lab"], "SELECT segment_id, reference_month, target_deterioration FROM lab"
    )
    q["latest_month_population"] = _with(["latest"], f"SELECT {FEATURE_COLUMNS} FROM latest")
    q["panel_summary"] = _with(
        ["features"],
        """SELECT count(*) AS n_rows, count(target_deterioration) AS n_labelled,
            count(DISTINCT segment_id) AS n_segments, min(reference_month) AS first_month,
            max(reference_month) AS last_month, round(avg(target_deterioration), 6) AS target_mean
            FROM features""",
    )
    q["target_base_rate"] = _with(
        ["features"],
        """SELECT round(m, 6) AS base_rate, m BETWEEN 0.03 AND 0.40 AS is_healthy
            FROM (SELECT avg(target_deterioration) AS m FROM features)""",
    )

    q["scalar_safe_divide"] = _with(
        ["stg"],
        """SELECT state, count(*) AS n_rows, count(s) AS n_share, round(sum(s), 4) AS share_total,
            round(sum(coalesce(s - 1, 0)), 4) AS growth_total
            FROM (SELECT state, default_portfolio / nullif(active_portfolio, 0) AS s FROM stg)
            GROUP BY ALL""",
    )
    q["scalar_calendar"] = """
        SELECT day, CAST(date_trunc('month', day) AS DATE) AS month_start,
               CAST(date_trunc('month', day) - INTERVAL 6 MONTH AS DATE) AS six_before,
               CAST(date_trunc('month', day) + INTERVAL 6 MONTH AS DATE) AS six_after,
               last_day(day) AS month_end, CAST(year(day) AS BIGINT) AS year,
               CAST(month(day) AS BIGINT) AS month, CAST(quarter(day) AS BIGINT) AS quarter,
               date_diff('day', day, DATE '2002-01-01') AS age_days, CAST(6 AS BIGINT) AS n_months
        FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS day FROM orders)"""
    q["scalar_label_case"] = _label_case()
    q["scalar_target_rule"] = """
        SELECT CASE WHEN l_quantity <= 5 THEN NULL
                    WHEN l_tax - l_discount >= 0.005::DOUBLE
                     AND l_tax >= l_discount * 1.15::DOUBLE THEN 1 ELSE 0 END AS target,
               CASE WHEN l_discount >= 0.09::DOUBLE THEN 'Alto'
                    WHEN l_discount >= 0.05::DOUBLE THEN 'Médio' ELSE 'Baixo' END AS band,
               count(*) AS n_rows
        FROM lineitem GROUP BY ALL"""

    q["ks_auc_ap"] = _metrics()
    q["decile_lift"] = _with(
        ["lab"],
        """, ranked AS (SELECT target_deterioration AS y, count(*) OVER () AS n,
               row_number() OVER (ORDER BY score DESC, segment_id, reference_month) AS r FROM lab),
        cut AS (SELECT *, greatest(1, (10 * (r - 1) + n - 2) // (n - 1)) AS decil FROM ranked),
        ten AS (SELECT decil, count(*) AS c, sum(y) AS d FROM cut GROUP BY ALL)
        SELECT CAST(decil AS BIGINT) AS decil, c AS segmentos, CAST(d AS BIGINT) AS deterioraram,
               round(d / c, 6) AS taxa,
               round(sum(d) OVER (ORDER BY decil) / sum(d) OVER (), 6) AS captura_acumulada,
               round((d / c) / (sum(d) OVER () / sum(c) OVER ()), 6) AS lift,
               round(sum(d) OVER () / sum(c) OVER (), 6) AS base_rate
        FROM ten""",
    )
    q["feature_medians"] = _with(
        ["bounds"],
        "\nUNION ALL\n".join(
            f"""SELECT '{f}' AS feature, round(quantile_cont({f}, 0.5), 4) AS median
                FROM lab, bounds WHERE reference_month <= train_limit"""
            for f in FEATURE_NAMES
        ),
    )
    q["risk_band_cuts"] = _with(
        ["cuts"], f"SELECT {_round('medium_cut high_cut', 6)} FROM cuts"
    )
    q["risk_bands"] = _with(
        ["scores"], "SELECT segment_id, reference_month, score, risk_band FROM scores"
    )
    q["oot_split"] = _with(
        ["bounds"],
        """SELECT CASE WHEN reference_month >= test_start THEN 'test' ELSE 'train' END AS part,
            count(*) AS n_rows, CAST(sum(target_deterioration) AS BIGINT) AS n_positive,
            round(avg(target_deterioration), 6) AS base_rate,
            min(reference_month) AS first_month, max(reference_month) AS last_month,
            train_limit, test_start
            FROM lab, bounds WHERE reference_month >= test_start OR reference_month <= train_limit
            GROUP BY part, train_limit, test_start""",
    )

    q["dq_report"] = _with(["fact", "features"], _all_checks())
    q["dq_relationships"] = _with(
        ["fact"],
        _check(
            "relationships",
            "fact_credit_operation.modality_id",
            "SELECT count(*) FROM fact WHERE modality_id <= 10",
        )
        + " UNION ALL "
        + _check(
            "relationships",
            "fact_credit_operation.client_id",
            "SELECT count(*) FROM fact WHERE client_id NOT IN (SELECT client_id FROM dim_client)",
        ),
    )
    q["dq_unique_combo"] = _with(["features"], _unique_combos())
    q["source_freshness"] = _freshness()
    q["dq_gate_status"] = _with(
        ["features"],
        f""", report AS ({_unique_combos()} UNION ALL {_freshness()})
        SELECT count(*) FILTER (status = 'error') AS n_error,
               count(*) FILTER (status = 'warn') AS n_warn,
               count(*) FILTER (status = 'pass') AS n_pass,
               CASE WHEN count(*) FILTER (status = 'error') > 0 THEN 'stop' ELSE 'go' END AS gate
        FROM report""",
    )
    q["dq_reconciliation"] = _with(
        ["fact"],
        _check(
            "reconciliation",
            "fact = staging",
            "SELECT abs((SELECT count(*) FROM fact) - (SELECT count(*) FROM stg))",
        )
        + " UNION ALL "
        + _check(
            "reconciliation",
            "fact = sector rows",
            "SELECT count(*) - count(economic_activity_id) FROM fact",
        ),
    )
    q["month_completeness"] = f"""
        WITH filed AS (
            SELECT {FILE} AS file,
                   CASE WHEN {SHIP_END} = DATE '1997-03-31' THEN DATE '1997-04-01'
                        ELSE CAST(date_trunc('month', l_shipdate) AS DATE) END AS m
            FROM lineitem),
        calendar AS (
            SELECT CAST(unnest(generate_series(min(m), max(m), INTERVAL 1 MONTH)) AS DATE)
                AS month_start FROM filed)
        SELECT month_start, count(DISTINCT file) AS n_files,
               CASE count(DISTINCT file) WHEN 0 THEN 'missing' WHEN 1 THEN 'ok'
                   ELSE 'duplicate' END AS status
        FROM calendar LEFT JOIN filed ON m = month_start GROUP BY ALL"""
    q["rate_provisional_flag"] = """
        SELECT CAST(date_trunc('month', d) AS DATE) AS month_start, d AS last_day_seen,
               last_day(d) > d AS is_provisional
        FROM (SELECT max(CAST(o_orderdate AS DATE)) AS d FROM orders)"""

    q["rate_changes_as_of"] = _with(
        ["daily"],
        """, known AS (SELECT * FROM daily WHERE day <= DATE '1997-05-17'),
        ends AS (
            SELECT CAST(date_trunc('month', day) AS DATE) AS month_start, arg_max(value, day) AS rate,
                   max(day) = (SELECT max(day) FROM known) AND max(day) < last_day(max(day)) AS open
            FROM known GROUP BY ALL)
        SELECT a.month_start, round(a.rate, 6) AS selic_rate,
               CASE WHEN NOT a.open THEN round(a.rate - b.rate, 6) END AS selic_chg_6m
        FROM ends a LEFT JOIN ends b
            ON b.month_start = CAST(a.month_start - INTERVAL 6 MONTH AS DATE) AND NOT b.open""",
    )
    q["rate_intervals"] = _with(
        ["daily"],
        """SELECT day AS valid_from, lead(day) OVER (ORDER BY day) AS valid_to, value FROM daily""",
    )
    q["label_translation"] = _with(
        ["scores"],
        f"""SELECT reference_month, segment_id, state, {MODALITY_EN} AS credit_modality,
            {TYPE_EN} AS client_type, {SIZE_EN} AS client_size,
            {_round("active_portfolio", 4)}, {_round("default_rate early_delinquency_rate", 6)},
            score, {BAND_EN} AS risk_band FROM scores""",
    )
    weighted = "round(sum({0} * f.active_portfolio) / sum(f.active_portfolio), 6) AS {0}"
    q["band_trend"] = _with(
        ["scores"],
        f""", past AS (
            SELECT f.reference_month, {BAND_EN.replace("risk_band", "s.risk_band")} AS risk_band,
                   {weighted.format("f.default_rate").replace("AS f.", "AS ")},
                   {weighted.format("f.early_delinquency_rate").replace("AS f.", "AS ")},
                   round(sum(f.active_portfolio), 4) AS active_portfolio,
                   false AS is_forecast_window
            FROM features f JOIN scores s USING (segment_id) GROUP BY ALL)
        SELECT * FROM past
        UNION ALL
        SELECT CAST(m + to_months(CAST(k AS INTEGER)) AS DATE), band, NULL, NULL, NULL, true
        FROM (SELECT max(reference_month) AS m FROM past),
             unnest(generate_series(1, 6)) AS steps(k),
             unnest(['High', 'Medium', 'Low']) AS bands(band)""",
    )
    q["kpi_high_risk"] = _with(
        ["scores"], f"SELECT count(*) AS segments, {HIGH}, {HIGH_SHARE} FROM scores"
    )
    q["state_high_risk_share"] = _with(
        ["scores"], f"SELECT state, {HIGH}, {HIGH_SHARE} FROM scores GROUP BY ALL"
    )
    q["high_risk_breakdown"] = _with(
        ["scores"],
        f"""SELECT 'client_type' AS dimension, {TYPE_EN} AS value, {HIGH} FROM scores GROUP BY ALL
            UNION ALL
            SELECT 'credit_modality', {MODALITY_EN}, {HIGH} FROM scores GROUP BY ALL""",
    )
    q["watchlist_top"] = _with(
        ["scores"],
        f"""SELECT segment_id, {_round("default_rate early_delinquency_rate", 6)}, score,
            {BAND_EN} AS risk_band FROM scores WHERE client_type = 'PJ'
            ORDER BY scores.score DESC, segment_id LIMIT 10""",
    )
    q["zip_members_to_lines"] = f"""SELECT {FILE} AS file, count(*) AS n_lines
        FROM lineitem GROUP BY ALL"""
    return q
