"""Financial and statistical analytics (L): operators over the fixture views, each with DuckDB SQL of its own for the same rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from palimpsest.operators import economy as E
from palimpsest.operators import finance as L
from palimpsest.operators import statements as S
from palimpsest.operators.ranges import kept, stored
from palimpsest.plans.fixtures import sql, table, with_fixtures

QUERIES, ORACLES = {}, {}
#: Inputs that several queries share.
QUARTERS = "SELECT cik, concept, CAST(date_trunc('quarter', end_date) AS DATE) AS q, CAST(sum(CAST(val AS DECIMAL(14,2))) AS DECIMAL(22,2)) AS v FROM facts GROUP BY 1, 2, 3"
YEARS = "SELECT cik, concept, CAST(year(end_date) AS INTEGER) AS yr, CAST(sum(CAST(val AS DECIMAL(14,2))) AS DECIMAL(22,2)) AS v FROM facts GROUP BY 1, 2, 3"
MONTHLY = "(SELECT ticker, CAST(date_trunc('month', obs_date) AS DATE) AS m, avg(close) AS v FROM prices GROUP BY 1, 2)"
ROA = "SELECT cik, yr, sic, revenue, net_income, CAST(net_income AS DOUBLE) / nullif(CAST(revenue AS DOUBLE), 0) AS r FROM company_years"
SHARES = "(SELECT *, sum(share) OVER (PARTITION BY yr, sic ORDER BY rk ROWS UNBOUNDED PRECEDING) AS cum FROM (SELECT *, row_number() OVER (PARTITION BY yr, sic ORDER BY revenue DESC, cik) AS rk, CAST(revenue AS DOUBLE) / CAST(sum(revenue) OVER (PARTITION BY yr, sic) AS DOUBLE) AS share FROM company_years))"
CODES = "SELECT s_suppkey AS cik, s_nationkey AS sic FROM supplier"
ECONOMY = "SELECT CAST(year(o_orderdate) AS INTEGER) AS yr, CAST(sum(CAST(o_totalprice AS DECIMAL(14,2))) AS DOUBLE) AS macro, CAST(count(*) AS DOUBLE) AS orders FROM orders GROUP BY 1"


def query(oracle: str):
    """Registers a query of the platform with DuckDB SQL for its rows."""

    def add(f):
        QUERIES[f.__name__], ORACLES[f.__name__] = f, with_fixtures(oracle)
        return f

    return add


def rounded(df, digits, *cols):
    return df.withColumns({c: F.round(c, digits) for c in cols})


def years_of(spark, d):
    return table(spark, d, "company_years")


def months_of(spark, d):
    return E.monthly(table(spark, d, "prices"), ["ticker"], "obs_date", "close")


@query("""WITH f AS (SELECT * FROM facts WHERE form = '10-K' AND end_date <= filed AND val > 0 AND end_date - start_date BETWEEN 350 AND 380 AND concept IN ('RF', 'NO', 'AF')),
newest AS (SELECT * FROM f QUALIFY row_number() OVER (PARTITION BY cik, concept, end_date ORDER BY filed DESC, accession DESC, val DESC) = 1),
ranked AS (SELECT *, year(end_date - INTERVAL 182 DAY) AS fy FROM newest WHERE cik NOT IN (SELECT s_suppkey FROM supplier WHERE s_nationkey = 7))
SELECT cik, fy, concept, end_date, val FROM ranked QUALIFY row_number() OVER (PARTITION BY cik, fy ORDER BY end_date DESC, list_position(['RF', 'NO', 'AF'], concept)) = 1""")
def l1_company_years(spark, d):
    return L.company_years(table(spark, d, "facts"), sql(spark, d, CODES), ["RF", "NO", "AF"], [7])


@query(f"SELECT yr, sic, count(*) AS companies, round(max(share), 6) AS top1, round(sum(CASE WHEN rk <= 4 THEN share ELSE 0 END), 6) AS cr4, round(sum(share * share) * 10000, 3) AS hhi, min(CASE WHEN cum >= 0.5 THEN rk END) AS to_half FROM {SHARES} GROUP BY yr, sic")
def l2_concentration(spark, d):
    return rounded(L.concentration(years_of(spark, d), ["yr", "sic"], "revenue", ["cik"]), 6, "top1", "cr4").withColumn("hhi", F.round("hhi", 3))


@query("""SELECT cik, yr, code, CAST(floor(code / 100) AS BIGINT) AS sic2, CAST(floor(code / 10) AS BIGINT) AS sic3, CASE WHEN code // 100 BETWEEN 1 AND 9 THEN 'A' WHEN code // 100 BETWEEN 10 AND 14 THEN 'B' WHEN code // 100 BETWEEN 15 AND 17 THEN 'C' WHEN code // 100 BETWEEN 20 AND 39 THEN 'D' WHEN code // 100 BETWEEN 40 AND 49 THEN 'E'
 WHEN code // 100 BETWEEN 50 AND 51 THEN 'F' WHEN code // 100 BETWEEN 52 AND 59 THEN 'G' WHEN code // 100 BETWEEN 60 AND 67 THEN 'H' WHEN code // 100 BETWEEN 70 AND 89 THEN 'I' WHEN code // 100 BETWEEN 91 AND 97 THEN 'J' WHEN code // 100 = 99 THEN 'K' END AS division,
 CASE WHEN code < 1000 THEN 'farm' WHEN code < 1500 THEN 'mine' WHEN code < 4000 THEN 'make' ELSE 'serve' END AS sector, CASE WHEN revenue < 1000000 THEN 'small' ELSE 'large' END AS size,
 CASE WHEN cik % 6 IN (0, 1) THEN 'NYSE' WHEN cik % 6 = 2 THEN 'Nasdaq' WHEN cik % 6 = 3 THEN 'OTC' WHEN cik % 6 = 4 THEN 'Other exchange' ELSE 'No ticker listed' END AS exchange FROM (SELECT *, cik * 37 % 10000 AS code FROM company_years)""")
def l3_industry_codes(spark, d):
    rows = sql(spark, d, """SELECT cik, yr, cik * 37 % 10000 AS code, revenue, CASE cik % 6 WHEN 0 THEN array('NYSE', 'Nasdaq') WHEN 1 THEN array(NULL, 'NYSE Arca') WHEN 2 THEN array('OTC', 'Nasdaq') WHEN 3 THEN array('OTC') WHEN 4 THEN array('CBOE', NULL) ELSE array(CAST(NULL AS STRING)) END AS exchanges FROM company_years""")
    return L.industry_codes(rows, "code", [(1000, "farm"), (1500, "mine"), (4000, "make")], "serve", "revenue", 1_000_000, "exchanges").drop("revenue", "exchanges")


@query("""SELECT grain, count(*) AS n_groups, count(*) FILTER (WHERE n >= 5) AS large_groups, CAST(coalesce(sum(n) FILTER (WHERE n >= 5), 0) AS BIGINT) AS covered, count(*) FILTER (WHERE n = 1) AS singletons FROM (
 SELECT 'sic' AS grain, sic AS g, count(DISTINCT cik) AS n FROM company_years GROUP BY sic UNION ALL SELECT 'tens', CAST(floor(sic / 10) AS BIGINT), count(DISTINCT cik) FROM company_years GROUP BY 2) GROUP BY grain""")
def l4_grain_table(spark, d):
    return L.grain_table(years_of(spark, d), "cik", {"sic": F.col("sic"), "tens": F.floor(F.col("sic") / 10)}, 5)


@query(f"SELECT yr, sic, arg_max(name, row(revenue, cik, name)) AS label, count(*) AS companies, round(max(share), 6) AS top1, round(sum(share * share) * 10000, 3) AS hhi FROM {SHARES} GROUP BY yr, sic")
def l5_concentration_named(spark, d):
    out = L.concentration(years_of(spark, d), ["yr", "sic"], "revenue", ["cik"], "name")
    return out.select("yr", "sic", "label", "companies", F.round("top1", 6).alias("top1"), F.round("hhi", 3).alias("hhi"))


@query("""SELECT yr, min(rk) FILTER (WHERE c >= 0.25) AS r25, min(rk) FILTER (WHERE c >= 0.5) AS r50, min(rk) FILTER (WHERE c >= 0.8) AS r80, min(rk) FILTER (WHERE c >= 0.9) AS r90, min(rk) FILTER (WHERE c >= 0.99) AS r99 FROM (
 SELECT yr, row_number() OVER w AS rk, CAST(sum(revenue) OVER w AS DOUBLE) / CAST(sum(revenue) OVER (PARTITION BY yr) AS DOUBLE) AS c FROM company_years WINDOW w AS (PARTITION BY yr ORDER BY revenue DESC, cik ROWS UNBOUNDED PRECEDING)) GROUP BY yr""")
def l6_size_curve(spark, d):
    return L.size_curve(years_of(spark, d), ["yr"], "revenue", ["cik"], [0.25, 0.5, 0.8, 0.9, 0.99])


@query("""SELECT yr, sic, count(*) AS n, CAST(sum(revenue) AS DECIMAL(30,2)) AS total, round(2 * median(CAST(revenue AS DOUBLE)), 2) AS twice_median, round(CAST(sum(revenue) AS DOUBLE) / CAST(sum(sum(revenue)) OVER (PARTITION BY yr) AS DOUBLE), 6) AS share,
 round(count(*) FILTER (WHERE net_income < 0) / count(*), 6) AS losing FROM company_years GROUP BY yr, sic""")
def l7_mix_table(spark, d):
    return rounded(L.mix_table(years_of(spark, d), ["sic"], ["yr"], "revenue", "net_income"), 6, "share", "losing").withColumns({"total": F.col("total").cast("decimal(30,2)"), "twice_median": F.round(2 * F.col("median"), 2)}).drop("median")


@query("SELECT sic, yr, round(CAST(sum(net_income) AS DOUBLE) / CAST(sum(revenue) AS DOUBLE), 6) AS margin, count(*) FILTER (WHERE net_income < 0) AS losing, count(*) AS n FROM company_years GROUP BY sic, yr")
def l8_profitability(spark, d):
    return rounded(L.profitability(years_of(spark, d), ["sic", "yr"], "revenue", "net_income"), 6, "margin")


@query("""WITH c AS (SELECT *, row_number() OVER (PARTITION BY yr ORDER BY revenue DESC, cik) AS rk FROM company_years WHERE revenue > 0), t AS (SELECT yr, count(*) AS companies, CAST(sum(revenue) FILTER (WHERE rk <= 10) AS DOUBLE) / CAST(sum(revenue) AS DOUBLE) AS top10, CAST(sum(revenue) FILTER (WHERE rk <= 100) AS DOUBLE) / CAST(sum(revenue) AS DOUBLE) AS top100 FROM c GROUP BY yr),
g AS (SELECT yr, sic, round(sum(CAST(revenue AS DOUBLE) * CAST(revenue AS DOUBLE)) / (CAST(sum(revenue) AS DOUBLE) * CAST(sum(revenue) AS DOUBLE)) * 10000, 3) AS hhi FROM c WHERE sic IS NOT NULL GROUP BY yr, sic HAVING count(*) >= 3), h AS (SELECT yr, count(*) AS groups, median(hhi) AS m FROM g GROUP BY yr)
SELECT t.yr, companies, round(top10, 8) AS top10, round(top100, 8) AS top100, coalesce(groups, 0) AS groups, round(m, 3) AS median_hhi FROM t LEFT JOIN h ON h.yr = t.yr""")
def l9_concentration_over_time(spark, d):
    return rounded(L.concentration_over_time(years_of(spark, d), "yr", "sic", "revenue", ["cik"], 3), 8, "top10", "top100").withColumn("median_hhi", F.round("median_hhi", 3))


@query("""SELECT yr, round(CAST(sum(CASE WHEN cik = 10 THEN revenue ELSE 0 END) AS DOUBLE) / CAST(sum(revenue) AS DOUBLE), 8) AS of_all, round(CAST(sum(CASE WHEN cik = 10 THEN revenue ELSE 0 END) AS DOUBLE) / nullif(CAST(sum(CASE WHEN sic IN (SELECT sic FROM company_years WHERE cik = 10) THEN revenue ELSE 0 END) AS DOUBLE), 0), 8) AS of_sic,
 round(CAST(sum(CASE WHEN cik = 10 THEN revenue ELSE 0 END) AS DOUBLE) / nullif(CAST(sum(CASE WHEN sic // 10 IN (SELECT sic // 10 FROM company_years WHERE cik = 10) THEN revenue ELSE 0 END) AS DOUBLE), 0), 8) AS of_tens FROM company_years GROUP BY yr""")
def l10_share_at_grains(spark, d):
    rows = years_of(spark, d).withColumn("tens", F.floor(F.col("sic") / 10))
    return rounded(L.share_at_grains(rows, "cik", 10, "yr", "revenue", {"sic": "sic", "tens": "tens"}), 8, "of_all", "of_sic", "of_tens")


@query("SELECT f.y, f.filers, round(m.v, 4) AS macro FROM (SELECT year(filed) AS y, count(DISTINCT cik) AS filers FROM facts WHERE form = '10-K' GROUP BY 1) f JOIN (SELECT year(obs_date) AS y, avg(close) AS v FROM prices GROUP BY 1) m ON f.y = m.y")
def l11_filers_vs_macro(spark, d):
    return rounded(L.filers_vs_macro(table(spark, d, "facts"), ["10-K"], table(spark, d, "prices"), "obs_date", "close"), 4, "macro")


@query("""WITH r AS (SELECT cik, start_date, end_date, max(val) AS revenue FROM tags WHERE concept = 'Revenues' AND form = '10-K' AND end_date - start_date BETWEEN 350 AND 380 GROUP BY 1, 2, 3), c AS (SELECT CAST(date_trunc('month', obs_date) AS DATE) AS m, avg(close) AS v FROM prices GROUP BY 1), b AS (SELECT avg(v) AS b FROM c WHERE year(m) = 1996)
SELECT cik, r.start_date, r.end_date, count(*) AS index_months, round(revenue * b / avg(v), 2) AS real FROM r JOIN c ON c.m >= r.start_date AND c.m < r.end_date CROSS JOIN b GROUP BY cik, r.start_date, r.end_date, revenue, b""")
def l12_deflate(spark, d):
    """Fiscal years of any end at 1996 prices, by the months of the index inside each."""
    flows = tags_of(spark, d).filter("concept = 'Revenues' AND form = '10-K' AND datediff(end_date, start_date) BETWEEN 350 AND 380").groupBy("cik", "start_date", "end_date").agg(F.max("val").alias("revenue"))
    index = table(spark, d, "prices").groupBy(F.trunc("obs_date", "month").alias("m")).agg(F.avg("close").alias("v"))
    return rounded(L.deflate(flows, "start_date", "end_date", "revenue", index, "m", "v", 1996), 2, "real").drop("revenue", "index_mean")


@query("""SELECT sic, round(CAST(sum(a) AS DOUBLE) / nullif(CAST(sum(b) AS DOUBLE), 0), 6) AS ratio FROM (SELECT cik, max(CASE WHEN concept = 'AF' THEN CAST(val AS DECIMAL(14,2)) END) AS a, max(CASE WHEN concept = 'RF' THEN CAST(val AS DECIMAL(14,2)) END) AS b FROM facts
 WHERE end_date BETWEEN DATE '1996-01-01' AND DATE '1996-12-31' GROUP BY cik) JOIN (SELECT s_suppkey AS cik, s_nationkey AS sic FROM supplier) USING (cik) GROUP BY sic""")
def l13_ratio_by_group(spark, d):
    return rounded(L.ratio_by_group(table(spark, d, "facts"), sql(spark, d, CODES), "AF", "RF", ("1996-01-01", "1996-12-31"), "sic"), 6, "ratio")


@query(f"""SELECT yr, CAST(sum(revenue) AS DECIMAL(30,2)) AS total, CAST(sum(CASE WHEN rk <= 20 THEN revenue END) AS DECIMAL(30,2)) AS top, round(CAST(sum(revenue) AS DOUBLE) / any_value(macro), 8) AS of_macro
 FROM (SELECT *, row_number() OVER (PARTITION BY yr ORDER BY revenue DESC, cik) AS rk FROM company_years) LEFT JOIN ({ECONOMY}) USING (yr) GROUP BY yr""")
def l14_frame_totals(spark, d):
    out = L.frame_totals(years_of(spark, d), "yr", "revenue", ["cik"], 20, sql(spark, d, ECONOMY).select("yr", "macro"))
    return rounded(out, 8, "of_macro").withColumns({c: F.col(c).cast("decimal(30,2)") for c in ("total", "top")})


@query("SELECT year(end_date) AS yr, form, quantile_cont(filed - end_date, 0.1) AS p10, median(filed - end_date) AS med, quantile_cont(filed - end_date, 0.9) AS p90, round(count(*) FILTER (WHERE filed - end_date > 60) / count(*), 6) AS late FROM facts GROUP BY 1, 2")
def l15_filing_lag(spark, d):
    return rounded(L.filing_lag(table(spark, d, "facts").withColumn("yr", F.year("end_date")), ["yr", "form"], 60), 6, "late")


@query(f"SELECT yr, round(CAST(sum(revenue) AS DOUBLE) / any_value(macro), 8) AS of_macro, round(CAST(sum(revenue) AS DOUBLE) / any_value(orders), 6) AS of_orders FROM company_years JOIN ({ECONOMY}) USING (yr) GROUP BY yr")
def l16_coverage_ratios(spark, d):
    return rounded(L.coverage_ratios(years_of(spark, d), "yr", "revenue", sql(spark, d, ECONOMY)), 8, "of_macro").withColumn("of_orders", F.round("of_orders", 6))


@query("""SELECT coalesce(a.k, b.k) AS k, round(coalesce(a.v / sum(a.v) OVER (), 0), 8) AS share, round(coalesce(b.v / sum(b.v) OVER (), 0), 8) AS other_share FROM (SELECT sic AS k, CAST(sum(revenue) AS DOUBLE) AS v FROM company_years GROUP BY 1) a
 FULL JOIN (SELECT c_nationkey AS k, CAST(count(*) AS DOUBLE) AS v FROM customer WHERE c_nationkey <> 3 GROUP BY 1) b ON a.k = b.k""")
def l17_sector_shares(spark, d):
    filers, others = years_of(spark, d).select(F.col("sic").alias("k"), F.col("revenue").alias("v")), sql(spark, d, "SELECT c_nationkey AS k, 1 AS v FROM customer WHERE c_nationkey <> 3")
    return rounded(L.sector_shares(filers, others, "k", "v"), 8, "share", "other_share")


#: Lines of a statement: period and concepts in order of preference.
LINES = {
    "revenue": ("annual", ["Revenues", "Sales"]), "cost_of_revenue": ("annual", ["CostOfRevenue", "CostOfGoods"]), "operating_income": ("annual", ["OperatingIncome"]), "net_income": ("annual", ["NetIncome"]), "capex": ("annual", ["Capex"]),
    "d_and_a": ("annual", ["Depreciation", "DepreciationAndAmortization"]), "total_assets": ("instant", ["Assets"]), "equity": ("instant", ["Equity"]), "receivables": ("instant", ["Receivables"]), "inventory": ("instant", ["Inventory"]),
    "payables": ("instant", ["Payables"]), "net_ppe": ("instant", ["PPE"]), "current_assets": ("instant", ["CurrentAssets"]), "current_liabilities": ("instant", ["CurrentLiabilities"]),
}
AS_OF, LARGEST = "2000-03-01", ("d_and_a",)
#: The same by SQL: reports, their facts, the line picked of each measure, statements side by side.
STATEMENT_SQL = f"""WITH acc AS (SELECT cik, accession, coalesce(max(end_date) FILTER (WHERE start_date IS NOT NULL AND end_date - start_date BETWEEN 350 AND 380), max(end_date)) AS period_end, min(filed) AS filed FROM tags
 WHERE form = '10-K' AND end_date <= filed AND filed <= DATE '{AS_OF}' GROUP BY 1, 2),
k AS (SELECT * FROM acc WHERE filed > DATE '{AS_OF}' - INTERVAL 1 YEAR QUALIFY row_number() OVER (PARTITION BY cik ORDER BY filed DESC, accession DESC) = 1),
m(measure, period, priority, concept) AS (VALUES {", ".join(f"('{m}', '{p}', {i}, '{c}')" for m, (p, cs) in LINES.items() for i, c in enumerate(cs))}),
x AS (SELECT f.cik, k.accession, k.period_end, m.*, f.start_date, f.end_date, f.val FROM tags f JOIN k ON k.cik = f.cik AND k.accession = f.accession JOIN m ON m.concept = f.concept
 WHERE (m.period = 'annual' AND f.end_date = k.period_end AND f.end_date - f.start_date BETWEEN 350 AND 380) OR (m.period = 'instant' AND f.start_date IS NULL AND (f.end_date = k.period_end OR k.period_end - f.end_date BETWEEN 350 AND 380))),
v AS (SELECT cik, measure, priority, max(val) FILTER (WHERE end_date = period_end) AS close, arg_max(val, end_date) FILTER (WHERE end_date < period_end) AS opening, max(end_date - start_date + 1) FILTER (WHERE period = 'annual') AS days FROM x GROUP BY cik, measure, priority, concept),
line AS (SELECT * FROM v WHERE close IS NOT NULL QUALIFY row_number() OVER (PARTITION BY cik, measure ORDER BY CASE WHEN measure = 'd_and_a' THEN -close END, priority) = 1),
s AS (SELECT cik, {", ".join([f"max(close) FILTER (WHERE measure = '{m}') AS {m}" for m in LINES] + [f"(max(close) FILTER (WHERE measure = '{m}') + max(opening) FILTER (WHERE measure = '{m}')) / 2 AS avg_{m}" for m, (p, _) in LINES.items() if p == "instant"])}, max(days) FILTER (WHERE measure = 'revenue') AS days FROM line GROUP BY cik)"""


def tags_of(spark, d):
    """The tagged facts, derived once and stored: the operators read them several times. The quarters and spans that they are made of are stored first, as each branch of the facts reads them."""
    made: dict[str, str] = {}
    for name in ("fiscal_quarters", "fiscal_spans"):
        made[name] = stored(table(spark, d, name, made))
    return kept(table(spark, d, "tags", made))


def statements_of(spark, d):
    return S.statements(tags_of(spark, d), LINES, AS_OF, LARGEST)


@query(f"{STATEMENT_SQL} SELECT k.accession, k.period_end, k.filed, s.* FROM k JOIN s ON s.cik = k.cik")
def l18_statements(spark, d):
    return statements_of(spark, d)


@query(f"""{STATEMENT_SQL} SELECT cik, round((revenue - cost_of_revenue) / revenue, 6) AS gross_margin, round(operating_income / revenue, 6) AS operating_margin, round(net_income / revenue, 6) AS net_margin, round(net_income / nullif(avg_total_assets, 0), 6) AS return_on_assets,
 round(CASE WHEN equity > 0 AND avg_equity > 0 THEN net_income / avg_equity END, 6) AS return_on_equity, round(avg_receivables / revenue * days, 6) AS receivable_days, round(avg_inventory / nullif(cost_of_revenue, 0) * days, 6) AS inventory_days, round(avg_payables / nullif(cost_of_revenue, 0) * days, 6) AS payable_days,
 round((avg_receivables / revenue + (avg_inventory - avg_payables) / nullif(cost_of_revenue, 0)) * days, 6) AS cash_cycle, round(capex / revenue, 6) AS capex_to_revenue, round(capex / nullif(d_and_a, 0), 6) AS capex_to_depreciation, round(revenue / nullif(avg_net_ppe, 0), 6) AS ppe_turnover,
 round(revenue / nullif(avg_total_assets, 0), 6) AS asset_turnover, round(current_assets / nullif(current_liabilities, 0), 6) AS current_ratio, round(CASE WHEN equity > 0 THEN total_assets / equity END, 6) AS assets_to_equity FROM s WHERE revenue > 0""")
def l19_ratios(spark, d):
    return rounded(S.ratios(statements_of(spark, d), ["cik"]), 6, *S.RATIOS)


@query(f"""WITH r AS ({ROA}), long AS (SELECT cik, yr, measure, value, unnest(['sector', 'year']) AS rung, unnest([CAST(sic AS VARCHAR) || '/' || yr, CAST(yr AS VARCHAR)]) AS peers
 FROM (SELECT cik, yr, sic, 'r' AS measure, r AS value FROM r UNION ALL SELECT cik, yr, sic, 'size', CAST(revenue AS DOUBLE) FROM r) WHERE value IS NOT NULL)
SELECT cik, yr, measure, rung, round(percent_rank() OVER (PARTITION BY rung, peers, measure ORDER BY value), 6) AS pct, count(*) OVER (PARTITION BY rung, peers, measure) AS n, round(median(value) OVER (PARTITION BY rung, peers, measure), 5) AS peer_median FROM long""")
def l20_peer_ranks(spark, d):
    rows = sql(spark, d, ROA).select("cik", "yr", "r", F.col("revenue").cast("double").alias("size"), F.concat_ws("/", F.col("sic").cast("string"), F.col("yr").cast("string")).alias("sector"), F.col("yr").cast("string").alias("year"))
    return L.peer_ranks(rows, ["cik", "yr"], ["r", "size"], ["sector", "year"]).select("cik", "yr", "measure", "rung", F.round("pct", 6).alias("pct"), "n", F.round("peer_median", 5).alias("peer_median"))


RESTATED = """SELECT cik, concept, end_date, first_val, last_val, n, disagreed, abs(last_val / nullif(first_val, 0) - 1) AS size, CASE WHEN list_bool_or([abs(abs(last_val / nullif(first_val, 0)) / x - 1) < 0.01 FOR x IN [0.000001, 0.001, 1000.0, 1000000.0]]) THEN 'scale' WHEN dform LIKE '%/A' THEN 'amended' ELSE 'later' END AS how FROM (
 SELECT cik, concept, end_date, any_value(f) AS first_val, any_value(l) AS last_val, count(*) AS n, min(filed) FILTER (WHERE val <> f) AS disagreed, arg_min(form, row(filed, accession, val, form)) FILTER (WHERE val <> f) AS dform FROM (
 SELECT *, first_value(val) OVER w AS f, last_value(val) OVER w AS l FROM facts WINDOW w AS (PARTITION BY cik, concept, end_date ORDER BY filed, accession, val ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)) GROUP BY cik, concept, end_date) WHERE first_val <> last_val"""


def restated(spark, d):
    return L.restatements(table(spark, d, "facts"), ["cik", "concept", "end_date"], [0.01, 0.05, 0.2, 1.0])


@query(f"SELECT cik, concept, end_date, first_val, last_val, n, disagreed, round(size, 6) AS size, len([b FOR b IN [0.01, 0.05, 0.2, 1.0] IF b <= size]) AS band, how FROM ({RESTATED})")
def l21_restatements(spark, d):
    return rounded(restated(spark, d), 6, "size").withColumn("band", F.col("band").cast("long"))


@query(f"SELECT year(end_date) AS yr, count(*) AS restated, count(DISTINCT cik) AS companies FROM ({RESTATED}) GROUP BY 1")
def l22_restatement_summary(spark, d):
    return L.restatement_summary(restated(spark, d).withColumn("yr", F.year("end_date")), "yr")


#: What the panel and the quarters' queries read of each company.
ANCHORED_SQL = """WITH f AS (SELECT * FROM tags WHERE form IN ('10-K', '10-K/A') AND end_date <= filed AND concept IN ('Revenues', 'NetIncome', 'Assets') AND (start_date IS NULL OR end_date - start_date BETWEEN 350 AND 380)),
fye AS (SELECT DISTINCT cik, max(end_date) AS end_date FROM f WHERE start_date IS NOT NULL GROUP BY cik, accession),
latest AS (SELECT f.* FROM f JOIN fye ON fye.cik = f.cik AND fye.end_date = f.end_date QUALIFY row_number() OVER (PARTITION BY f.cik, concept, f.end_date ORDER BY filed DESC, accession DESC) = 1),
p AS (SELECT cik, CAST(year(end_date - INTERVAL 182 DAY) AS INTEGER) AS yr, end_date, concept, val FROM latest),
panel AS (SELECT * FROM p QUALIFY end_date = max(end_date) OVER (PARTITION BY cik, yr))"""


def panel_of(spark, d):
    return S.anchored_panel(tags_of(spark, d), ["Revenues", "NetIncome", "Assets"])


@query(f"{ANCHORED_SQL} SELECT * FROM panel")
def l23_anchored_panel(spark, d):
    return panel_of(spark, d)


#: Current and annual reports, and names in use until and from a date.
REPORTS = "SELECT o_custkey AS cik, CAST(o_orderdate AS DATE) AS filing_date, CASE WHEN o_orderstatus = 'F' THEN '10-K' WHEN o_orderkey % 3 = 0 THEN '8-K/A' ELSE '8-K' END AS form, CASE WHEN o_orderkey % 9 = 0 THEN '1.03,9.01' WHEN o_orderkey % 5 = 0 THEN '8.01,5.01' ELSE '15.01,2.01' END AS items FROM orders"
FORMER = "SELECT s_suppkey AS cik, s_name AS name, CASE WHEN s_suppkey % 4 = 0 THEN '[]' ELSE '[{\"name\":\"Old ' || s_name || '\",\"from\":\"1999-05-01T00:00:00.000Z\",\"to\":\"2001-03-31T00:00:00.000Z\"},{\"name\":\"First\",\"from\":\"1980-01-01\",\"to\":\"1999-04-30\"}]' END AS former_names FROM supplier"


@query(f"""{ANCHORED_SQL}, r AS (SELECT * FROM panel WHERE concept = 'Revenues' AND val IS NOT NULL), last AS (SELECT cik, max(yr) AS last_year, arg_max(end_date, yr) AS last_end, min(yr) FILTER (WHERE val = top) AS peak_year FROM (SELECT *, max(val) OVER (PARTITION BY cik) AS top FROM r) GROUP BY cik),
e AS (SELECT cik, max(filing_date) FILTER (WHERE form LIKE '8-K%' AND regexp_matches(items, '(^|,)1[.]03(,|$)')) AS b, max(filing_date) FILTER (WHERE form LIKE '8-K%' AND regexp_matches(items, '(^|,)5[.]01(,|$)')) AS c, max(filing_date) FILTER (WHERE form IN ('10-K', '10-KT')) AS last_report FROM ({REPORTS}) GROUP BY cik)
SELECT last.cik, CASE WHEN last.cik % 4 <> 0 AND last_report BETWEEN DATE '1999-05-01' AND DATE '2001-03-31' THEN 'Old ' || s_name WHEN last.cik % 4 <> 0 AND last_report BETWEEN DATE '1980-01-01' AND DATE '1999-04-30' THEN 'First' ELSE s_name END AS name, last_year, last_end, peak_year, last_report,
 CASE WHEN last_report >= DATE '2001-07-01' THEN 'still_files' WHEN b >= last_end - 365 THEN 'bankruptcy' WHEN c >= last_end - 365 THEN 'taken_over' ELSE 'unknown' END AS why FROM last LEFT JOIN e ON e.cik = last.cik LEFT JOIN supplier ON s_suppkey = last.cik WHERE last_year < 2002""")
def l24_exits(spark, d):
    panel = panel_of(spark, d).filter("concept = 'Revenues'").withColumnRenamed("val", "value")
    return S.exits(panel, sql(spark, d, REPORTS), sql(spark, d, FORMER), 2002, "2001-07-01")


@query("""WITH a AS (SELECT cik, CAST(year(end_date) AS INTEGER) AS yr, concept, CASE WHEN filed < DATE '1998-06-01' AND concept = 'AF' THEN val * 2 WHEN filed < DATE '1998-06-01' AND concept = 'RF' THEN val / 2 ELSE val END AS v FROM facts),
w AS (SELECT cik, yr, max(v) FILTER (WHERE concept = 'AF') AS inventory, max(v) FILTER (WHERE concept = 'RF') AS cost, max(v) FILTER (WHERE concept = 'NO') AS receivables, max(v) FILTER (WHERE concept = 'NF') AS payables, sum(v) AS revenue FROM a GROUP BY 1, 2)
SELECT cik, yr, round(inventory / nullif(cost, 0) * 365, 6) AS dio, round(receivables / nullif(revenue, 0) * 365, 6) AS dso, round(payables / nullif(cost, 0) * 365, 6) AS dpo, round((inventory / nullif(cost, 0) + receivables / nullif(revenue, 0) - payables / nullif(cost, 0)) * 365, 6) AS ccc FROM w""")
def l25_split_adjusted(spark, d):
    """Two concepts stand for a count and a figure per share; the year's figures then give the working-capital days."""
    rows = S.split_adjusted(table(spark, d, "facts"), "1998-06-01", 2.0, ["AF"], ["RF"]).withColumn("yr", F.year("end_date"))
    of = lambda c: F.max(F.when(F.col("concept") == c, F.col("adjusted")))
    wide = rows.groupBy("cik", "yr").agg(of("AF").alias("inventory"), of("RF").alias("cost"), of("NO").alias("receivables"), of("NF").alias("payables"), F.sum("adjusted").alias("revenue"))
    return rounded(S.working_capital(wide), 6, "dio", "dso", "dpo", "ccc").select("cik", "yr", "dio", "dso", "dpo", "ccc")


#: Spans filed by an item's preferred concept, by SQL.
SPANS_SQL = """WITH raw AS (SELECT *, concept = 'Revenues' AS new, form <> '10-Q' AS k, end_date - start_date AS days FROM tags WHERE concept IN ('Revenues', 'Sales') AND form IN ('10-Q', '10-K', '10-K/A') AND end_date - start_date BETWEEN 80 AND 380
 QUALIFY row_number() OVER (PARTITION BY cik, concept, form <> '10-Q', start_date, end_date ORDER BY filed DESC, accession DESC) = 1),
one AS (SELECT * FROM raw QUALIFY row_number() OVER (PARTITION BY cik, k, start_date, end_date ORDER BY new DESC) = 1),
sp AS (SELECT *, CASE WHEN days BETWEEN 80 AND 100 THEN 1 WHEN days BETWEEN 170 AND 190 THEN 2 WHEN days BETWEEN 260 AND 280 THEN 3 WHEN days BETWEEN 350 AND 380 THEN 4 END AS quarters FROM one),
y AS (SELECT y.cik, y.start_date, y.end_date, y.val AS year, count(*) FILTER (WHERE q.quarters = 1 AND NOT q.k AND y.end_date - q.end_date > 7) AS n, sum(q.val) FILTER (WHERE q.quarters = 1 AND NOT q.k AND y.end_date - q.end_date > 7) AS three,
 max(q.val) FILTER (WHERE q.quarters = 3 AND NOT q.k AND abs(q.start_date - y.start_date) <= 7) AS nine_months, max(q.val) FILTER (WHERE q.quarters = 1 AND q.k AND y.end_date - q.end_date <= 7) AS tagged,
 max(q.end_date) FILTER (WHERE q.quarters = 1 AND NOT q.k) AS last, count(*) FILTER (WHERE q.quarters = 1 AND NOT q.k) AS n_all
 FROM sp y JOIN sp q ON q.cik = y.cik AND q.quarters IN (1, 3) AND q.start_date >= y.start_date - 7 AND q.end_date <= y.end_date + 7 WHERE y.quarters = 4 AND y.k GROUP BY 1, 2, 3, 4)"""


@query(f"""{SPANS_SQL}, every AS (SELECT cik, start_date, end_date, val, 'reported' AS source, CAST(k AS INTEGER) AS o FROM sp WHERE quarters = 1
 UNION ALL SELECT cik, CAST(last + 1 AS DATE), end_date, year - three, 'less_quarters', 2 FROM y WHERE n_all = 3 AND end_date - last BETWEEN 80 AND 100
 UNION ALL SELECT a.cik, CAST(b.end_date + 1 AS DATE), a.end_date, a.val - b.val, 'difference', a.quarters + 1 FROM sp a JOIN sp b ON a.cik = b.cik AND b.quarters = a.quarters - 1 AND abs(a.start_date - b.start_date) <= 7 WHERE a.quarters > 1 AND a.end_date - b.end_date - 1 BETWEEN 80 AND 100
 UNION ALL SELECT a.cik, a.start_date, CAST(b.start_date - 1 AS DATE), a.val - b.val, 'difference', a.quarters + 1 FROM sp a JOIN sp b ON a.cik = b.cik AND b.quarters = a.quarters - 1 AND abs(a.end_date - b.end_date) <= 7 AND abs(a.start_date - b.start_date) > 7 WHERE a.quarters > 1 AND b.start_date - 1 - a.start_date BETWEEN 80 AND 100),
q AS (SELECT *, CAST(date_trunc('quarter', end_date - 45) AS DATE) AS q FROM every QUALIFY row_number() OVER (PARTITION BY cik, date_trunc('quarter', end_date - 45) ORDER BY o, end_date, start_date, val, source) = 1)
SELECT q.cik, q.q, q.start_date, q.end_date, q.val, q.source, y.nine_months, y.tagged, abs(y.three - y.nine_months) <= 0.001 * abs(y.nine_months) AS nine_agrees, abs(y.year - y.three - y.tagged) <= 0.001 * abs(y.tagged) AS tagged_agrees FROM q LEFT JOIN (SELECT * FROM y WHERE n = 3) y ON y.cik = q.cik AND y.end_date = q.end_date""")
def l26_quarterly(spark, d):
    """Quarters of revenue, and beside those that end a year how the year's spans agree."""
    spans = S.filed_spans(tags_of(spark, d), {"revenue": ["Revenues", "Sales"]})
    checks = S.quarter_checks(spans, 0.001).select("cik", "end_date", "nine_months", "tagged", "nine_agrees", "tagged_agrees")
    return S.quarters(spans).drop("item").join(checks, ["cik", "end_date"], "left")


@query("""WITH f AS (SELECT cik, concept, frame, start_date, end_date, val FROM tags WHERE concept IN ('Revenues', 'Sales') AND regexp_matches(frame, '^CY[0-9]{4}(Q[1-4])?$')),
qq AS (SELECT *, make_date(CAST(substr(frame, 3, 4) AS INTEGER), (CAST(substr(frame, 8, 1) AS INTEGER) - 1) * 3 + 1, 1) AS q FROM f WHERE length(frame) = 8), yy AS (SELECT * FROM f WHERE length(frame) = 6),
q4 AS (SELECT yy.cik, yy.concept, CAST(date_trunc('quarter', yy.end_date - INTERVAL 45 DAY) AS DATE) AS q, yy.val - sum(qq.val) AS val FROM yy JOIN qq ON qq.cik = yy.cik AND qq.concept = yy.concept AND qq.start_date >= yy.start_date - INTERVAL 7 DAY AND qq.end_date <= yy.end_date + INTERVAL 7 DAY
 GROUP BY yy.cik, yy.concept, yy.start_date, yy.end_date, yy.val HAVING count(*) = 3 AND max(qq.q) = date_trunc('quarter', yy.end_date - INTERVAL 45 DAY) - INTERVAL 3 MONTH),
a AS (SELECT cik, q, val, FALSE AS derived FROM qq UNION ALL SELECT cik, q, val, TRUE FROM q4 WHERE NOT EXISTS (SELECT 1 FROM qq WHERE qq.cik = q4.cik AND qq.concept = q4.concept AND qq.q = q4.q))
SELECT cik, q, max(val) AS v, coalesce(max(val) FILTER (WHERE NOT derived) < max(val), TRUE) AS derived FROM a WHERE q >= DATE '1996-07-01' GROUP BY cik, q""")
def l27_quarterly_revenue(spark, d):
    return S.quarterly_revenue(tags_of(spark, d), ["Revenues", "Sales"], "1996-07-01")


@query(f"SELECT a.q, count(*) AS n, round(CAST(sum(a.v) AS DOUBLE) / CAST(sum(b.v) AS DOUBLE) - 1, 6) AS growth FROM (SELECT cik, q, max(v) AS v FROM ({QUARTERS}) GROUP BY cik, q) a JOIN (SELECT cik, CAST(q + INTERVAL 1 YEAR AS DATE) AS q, max(v) AS v FROM ({QUARTERS}) GROUP BY 1, 2) b ON a.cik = b.cik AND a.q = b.q GROUP BY a.q")
def l28_same_company_growth(spark, d):
    return rounded(L.same_company_growth(sql(spark, d, QUARTERS).groupBy("cik", "q").agg(F.max("v").alias("v")), "cik"), 6, "growth")


@query("SELECT min(a.cik) AS cik, a.yr, round(CAST(a.net_income AS DOUBLE) / nullif(CAST(b.revenue AS DOUBLE), 0), 6) AS ret FROM company_years a JOIN company_years b ON a.cik = b.cik AND a.yr = b.yr + 1 GROUP BY a.yr, a.net_income, b.revenue")
def l29_return_on_capital(spark, d):
    return rounded(L.return_on_capital(years_of(spark, d), "cik", "yr", "net_income", "revenue"), 6, "ret").select("cik", "yr", "ret")


@query(f"""SELECT yr, round(min(r) FILTER (WHERE c >= 0.1), 6) AS p10, round(min(r) FILTER (WHERE c >= 0.5), 6) AS p50, round(min(r) FILTER (WHERE c >= 0.9), 6) AS p90, round(CAST(sum(net_income) AS DOUBLE) / CAST(sum(revenue) AS DOUBLE), 6) AS pooled FROM (
 SELECT *, CAST(sum(revenue) OVER (PARTITION BY yr ORDER BY r, cik ROWS UNBOUNDED PRECEDING) AS DOUBLE) / CAST(sum(revenue) OVER (PARTITION BY yr) AS DOUBLE) AS c FROM ({ROA})) GROUP BY yr""")
def l30_capital_percentiles(spark, d):
    return rounded(L.capital_percentiles(sql(spark, d, ROA), ["yr"], "r", ["cik"], "revenue", "net_income", [0.1, 0.5, 0.9]), 6, "p10", "p50", "p90", "pooled")


@query(f"""WITH r AS ({ROA}), b AS (SELECT cik, round(r, 4) AS v, revenue AS w FROM r WHERE yr = 1996 AND r IS NOT NULL), s AS (SELECT v, sum(w) AS w FROM b GROUP BY v),
p AS (SELECT v, least(floor(5 * CAST(sum(w) OVER (ORDER BY v) - w AS DOUBLE) / CAST(sum(w) OVER () AS DOUBLE)), 4) + 1 AS g FROM s)
SELECT CAST(g AS BIGINT) AS g, c.yr, CAST(sum(c.net_income) AS DECIMAL(30,4)) AS income, round(CAST(sum(c.net_income) AS DOUBLE) / CAST(sum(c.revenue) AS DOUBLE), 6) AS pooled FROM b JOIN p ON p.v = b.v JOIN company_years c ON c.cik = b.cik GROUP BY 1, 2""")
def l31_cohort_track(spark, d):
    out = L.cohort_track(sql(spark, d, ROA), "cik", "yr", 1996, "r", "revenue", "net_income", 5)
    return rounded(out, 6, "pooled").withColumns({"income": F.col("income").cast("decimal(30,4)"), "g": F.col("g").cast("long")})


@query("""SELECT sic, round(CAST(sum(net_income) FILTER (WHERE yr <= 1997) AS DOUBLE) / CAST(sum(revenue) FILTER (WHERE yr <= 1997) AS DOUBLE), 6) AS early, round(CAST(sum(net_income) FILTER (WHERE yr BETWEEN 1998 AND 1999) AS DOUBLE) / CAST(sum(revenue) FILTER (WHERE yr BETWEEN 1998 AND 1999) AS DOUBLE), 6) AS middle,
 round(CAST(sum(net_income) FILTER (WHERE yr >= 2000) AS DOUBLE) / CAST(sum(revenue) FILTER (WHERE yr >= 2000) AS DOUBLE), 6) AS late FROM company_years GROUP BY sic""")
def l32_industry_returns(spark, d):
    return rounded(L.industry_returns(years_of(spark, d), "sic", "yr", "net_income", "revenue", {"early": (1900, 1997), "middle": (1998, 1999), "late": (2000, 2100)}), 6, "early", "middle", "late")


BACKLOG = "SELECT o_orderpriority AS p, CAST(date_trunc('month', o_orderdate) AS DATE) AS m, CAST(count(*) AS DOUBLE) AS orders, CAST(sum(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) AS DOUBLE) AS shipments, CAST(sum(CASE WHEN o_orderstatus <> 'F' THEN 1 ELSE 0 END) AS DOUBLE) AS backlog FROM orders GROUP BY 1, 2"


@query(f"SELECT p, count(gap) AS n, round(median(gap), 6) AS median_gap, round(max(gap), 6) AS worst FROM (SELECT p, abs(orders - shipments - (backlog - lag(backlog) OVER (PARTITION BY p ORDER BY m))) / orders AS gap FROM ({BACKLOG})) GROUP BY p")
def l33_identity_gap(spark, d):
    return rounded(E.identity_gap(sql(spark, d, BACKLOG), ["p"], "m", "orders", "shipments", "backlog"), 6, "median_gap", "worst")


LEVELS = "SELECT CAST(date_trunc('month', obs_date) AS DATE) AS m, avg(close) / 200000 AS level FROM ref_prices GROUP BY 1"


@query(f"""WITH r AS (SELECT ticker, a.m, a.v / l.level AS v FROM {MONTHLY} a JOIN ({LEVELS}) l ON l.m = a.m)
SELECT a.ticker, a.m, round(a.v / b.v - 1, 6) AS growth, (SELECT max(m) FROM r c WHERE c.ticker = a.ticker AND c.m < a.m AND c.v >= a.v) AS last_as_high FROM r a JOIN r b ON a.ticker = b.ticker AND a.m = CAST(b.m + INTERVAL 1 YEAR AS DATE)""")
def l34_real_growth(spark, d):
    return rounded(E.real_growth(months_of(spark, d), sql(spark, d, LEVELS), ["ticker"]), 6, "growth")


@query(f"""WITH c AS (SELECT a.m, a.v AS a, b.v AS b FROM {MONTHLY} a JOIN {MONTHLY} b ON a.m = b.m WHERE a.ticker = 'HIGH' AND b.ticker = 'URGENT'), g AS (SELECT c.*, c.a / p.a - 1 AS ga, c.b / p.b - 1 AS gb FROM c LEFT JOIN c p ON c.m = CAST(p.m + INTERVAL 1 YEAR AS DATE))
SELECT count(*) AS n, round(corr(ga, gb), 6) AS fit, round(median(abs(ga - gb)), 6) AS gap, round(avg(a / b), 6) AS level_ratio FROM g""")
def l35_pair_fit(spark, d):
    m = months_of(spark, d)
    return rounded(E.pair_fit(m.filter("ticker = 'HIGH'").select("m", "v"), m.filter("ticker = 'URGENT'").select("m", "v")), 6, "fit", "gap", "level_ratio")


@query(f"""WITH y AS (SELECT ticker, year(m) AS y, count(*) AS months, avg(v) AS mean FROM {MONTHLY} GROUP BY 1, 2 HAVING count(*) = 12)
SELECT a.ticker, a.y, a.months, round(a.mean, 4) AS mean, round(a.mean / b.mean - 1, 6) AS change FROM y a LEFT JOIN y b ON a.ticker = b.ticker AND a.y = b.y + 1""")
def l36_annual_table(spark, d):
    return rounded(E.annual_table(months_of(spark, d), ["ticker"]), 4, "mean").withColumn("change", F.round("change", 6))


@query(f"SELECT ticker, span, round(avg(v), 4) AS mean, round(arg_max(v, m) - arg_min(v, m), 4) AS change FROM {MONTHLY} a JOIN (VALUES ('early', 1995, 1997), ('late', 1998, 2000), ('all', 1995, 2000)) s(span, lo, hi) ON year(m) BETWEEN lo AND hi GROUP BY 1, 2")
def l37_period_averages(spark, d):
    return rounded(E.period_averages(months_of(spark, d), ["ticker"], F.year("m"), "v", "v", "m", {"early": (1995, 1997), "late": (1998, 2000), "all": (1995, 2000)}), 4, "mean", "change")


UNITS = "SELECT cik, concept, accession, start_date, end_date, filed, CASE WHEN accession % 3 = 0 THEN 'shares' ELSE 'USD' END AS unit, CASE WHEN (accession + length(form)) % 4 < 2 THEN 'IS' ELSE 'BS' END AS stmt FROM tags"


@query(f"""WITH f AS ({UNITS}), u AS (SELECT concept, arg_min(unit, row(-n, unit)) AS unit FROM (SELECT concept, unit, count(*) AS n FROM f GROUP BY 1, 2) GROUP BY 1), s AS (SELECT concept, arg_min(stmt, row(-n, stmt)) AS stmt FROM (SELECT concept, stmt, count(DISTINCT accession) AS n FROM f GROUP BY 1, 2) GROUP BY 1)
SELECT f.concept, count(*) AS n_facts, count(*) FILTER (WHERE start_date IS NULL) AS instants, count(*) FILTER (WHERE start_date IS NULL) * 2 > count(*) AS point_in_time, count(DISTINCT cik) AS filers, min(year(end_date)) AS first_year, max(year(end_date)) AS last_year, any_value(u.unit) AS unit, any_value(s.stmt) AS stmt FROM f JOIN u ON u.concept = f.concept LEFT JOIN s ON s.concept = f.concept GROUP BY f.concept""")
def l38_concept_index(spark, d):
    rows = kept(sql(spark, d, UNITS))
    return E.concept_index(rows, rows)


@query("SELECT cik, sic, min(end_date) AS first_date, max(end_date) AS last_date, max(filed) >= DATE '1998-10-01' AS recent FROM facts LEFT JOIN (SELECT s_suppkey AS cik, s_nationkey AS sic FROM supplier) USING (cik) GROUP BY cik, sic")
def l39_company_index(spark, d):
    return E.company_index(table(spark, d, "facts"), sql(spark, d, CODES), "1998-10-01")


@query("WITH f AS (SELECT year(filed) AS y, concept || form AS form FROM facts), t AS (SELECT form FROM f GROUP BY form ORDER BY count(*) DESC, form LIMIT 5) SELECT y, CASE WHEN form IN (SELECT form FROM t) THEN form ELSE 'other' END AS form, count(*) AS n FROM f GROUP BY 1, 2")
def l40_form_mix(spark, d):
    return E.form_mix(table(spark, d, "facts").withColumn("form", F.concat("concept", "form")), 5)


VALUES_OF = "SELECT n_name AS place, CAST(year(o_orderdate) AS INTEGER) AS year, CAST(sum(CAST(o_totalprice AS DECIMAL(14,2))) AS DECIMAL(24,2)) AS value FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2"
PEOPLE = "SELECT place, year, n + year - 1990 AS people FROM (SELECT n_name AS place, count(*) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1) a CROSS JOIN (SELECT 1994 AS year UNION ALL SELECT 1995 UNION ALL SELECT 1996) y"


@query(f"SELECT place, year, round(CAST(value AS DOUBLE) / people, 4) AS per_person, rank() OVER (PARTITION BY year ORDER BY CAST(value AS DOUBLE) / people DESC) AS rk FROM ({VALUES_OF}) v JOIN ({PEOPLE}) p USING (place, year) WHERE year IN (1995, 1996)")
def l41_per_person(spark, d):
    values, people = sql(spark, d, VALUES_OF), sql(spark, d, PEOPLE)
    known = values.filter("year IN (1995, 1996)").groupBy("place").count().filter("count = 2").select("place")
    return rounded(E.per_person(values.join(known, "place"), people.join(known, "place"), "place", [1995, 1996]), 4, "per_person")


LABELS = "SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN CAST(year(o_orderdate) AS VARCHAR(4)) WHEN 1 THEN 'FY' || CAST(year(o_orderdate) AS VARCHAR(4)) || '/' || substr(CAST(year(o_orderdate) + 1 AS VARCHAR(4)), 3) WHEN 2 THEN 'SY' || CAST(year(o_orderdate) AS VARCHAR(4)) || '/00' ELSE o_orderpriority END AS label, CASE o_custkey % 3 WHEN 0 THEN 1 WHEN 1 THEN 0 END AS rule FROM orders"


@query("SELECT o_orderkey, CAST(CASE WHEN o_orderkey % 4 = 0 THEN year(o_orderdate) WHEN o_orderkey % 4 IN (1, 2) THEN year(o_orderdate) + CASE o_custkey % 3 WHEN 0 THEN 1 WHEN 1 THEN 0 END END AS INTEGER) AS latest_actual FROM orders")
def l42_latest_actual(spark, d):
    return E.latest_actual(sql(spark, d, LABELS), "label", "rule").select("o_orderkey", "latest_actual")


@query("SELECT series_id, obs_date, value FROM obs WHERE vintage = (SELECT max(vintage) FROM obs)")
def l43_newest_edition(spark, d):
    return E.newest_edition(table(spark, d, "obs"), "vintage", "vintage").select("series_id", "obs_date", "value")


COUNTS = "SELECT n_name, CAST(year(o_orderdate) AS INTEGER) AS yr, o_orderkey % 7 = 0 AND year(o_orderdate) > 1994 AS projected, count(*) AS n FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2, 3"


@query(f"SELECT n_name, min(yr) FILTER (WHERE projected) AS first_projected, max(n) FILTER (WHERE yr = 1997) AS y1997, max(n) FILTER (WHERE yr = 1995) AS y1995, max(n) FILTER (WHERE yr = 1996) AS y1996 FROM ({COUNTS}) GROUP BY n_name")
def l44_population_panel(spark, d):
    return E.population_panel(sql(spark, d, COUNTS), "n_name", "yr", "n", "projected", [1997, 1995, 1996])


PLACES = "SELECT 'r' || CAST(r_regionkey AS VARCHAR(10)) AS id, CAST(NULL AS VARCHAR(10)) AS parent, r_name AS name, 'region' AS level FROM region UNION ALL SELECT 'n' || CAST(n_nationkey AS VARCHAR(10)), 'r' || CAST(n_regionkey AS VARCHAR(10)), n_name, 'country' FROM nation UNION ALL SELECT 's' || CAST(s_suppkey AS VARCHAR(10)), 'n' || CAST(s_nationkey AS VARCHAR(10)), s_name, 'city' FROM supplier"


@query("SELECT id, region FROM (SELECT 'r' || r_regionkey AS id, r_name AS region FROM region UNION ALL SELECT 'n' || n_nationkey, r_name FROM nation JOIN region ON n_regionkey = r_regionkey UNION ALL SELECT 's' || s_suppkey, r_name FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)")
def l45_location_region(spark, d):
    return E.location_region(sql(spark, d, PLACES), "level", "region").select("id", "region")


@query("""WITH g AS (SELECT cik, yr, rank() OVER (PARTITION BY yr ORDER BY revenue DESC) AS rk, CAST(revenue AS DOUBLE) / nullif(CAST(lag(revenue) OVER w AS DOUBLE), 0) - 1 AS growth, CAST(revenue AS DOUBLE) / nullif(CAST(first_value(revenue) OVER w AS DOUBLE), 0) AS multiple FROM company_years WINDOW w AS (PARTITION BY cik ORDER BY yr))
SELECT cik, yr, rk, round(growth, 6) AS growth, round(multiple, 6) AS multiple, coalesce(growth = min(growth) OVER (PARTITION BY cik) AND growth < 0, FALSE) AS largest_drop FROM g""")
def l46_growth_ranks(spark, d):
    return rounded(E.growth_ranks(years_of(spark, d), "cik", "yr", "revenue"), 6, "growth", "multiple")


WALK = "walk AS (SELECT o, a AS cur, 1 AS steps FROM edges UNION ALL SELECT w.o, e.a, w.steps + 1 FROM walk w JOIN edges e ON e.o = w.cur WHERE w.steps < 64)"


@query(f"WITH RECURSIVE {WALK} SELECT o, arg_max(cur, steps) AS survivor, CAST(max(steps) AS INTEGER) AS steps, FALSE AS looped FROM walk GROUP BY o")
def l47_lineage(spark, d):
    return E.lineage(table(spark, d, "edges"))


@query(f"WITH RECURSIVE {WALK}, l AS (SELECT o, arg_max(cur, steps) AS survivor, max(steps) AS steps FROM walk GROUP BY o) SELECT survivor, count(DISTINCT o) AS merged, CAST(max(steps) AS INTEGER) AS longest FROM l GROUP BY survivor")
def l48_survivors(spark, d):
    return E.survivors(E.lineage(table(spark, d, "edges")))


@query("SELECT y.y, count(*) AS alive FROM (SELECT unnest(generate_series(1990, 2005)) AS y) y JOIN (SELECT o_custkey, min(year(o_orderdate)) AS a, max(year(o_orderdate)) AS b FROM orders GROUP BY 1) e ON y.y BETWEEN e.a AND e.b GROUP BY y.y")
def l49_alive_by_year(spark, d):
    lives = table(spark, d, "orders").groupBy("o_custkey").agg(F.min(F.year("o_orderdate")).alias("a"), F.max(F.year("o_orderdate")).alias("b"))
    return E.alive_by_year(lives, "a", "b").withColumn("y", F.col("y").cast("long"))


@query("""WITH p AS (SELECT s_suppkey AS k, s_nationkey AS city, CASE WHEN s_suppkey % 4 <> 0 THEN CAST(s_acctbal AS DOUBLE) END AS lat FROM supplier WHERE s_suppkey % 9 <> 0 UNION ALL SELECT s_suppkey, s_nationkey, NULL FROM supplier WHERE s_suppkey % 9 = 0)
SELECT k, city, round(coalesce(lat, avg(lat) OVER (PARTITION BY city)), 4) AS lat, lat IS NULL AS imputed FROM p""")
def l50_impute_location(spark, d):
    places = sql(spark, d, "SELECT s_suppkey AS k, s_nationkey AS city, CASE WHEN s_suppkey % 4 <> 0 THEN CAST(s_acctbal AS DOUBLE) END AS lat FROM supplier WHERE s_suppkey % 9 <> 0")
    return rounded(E.impute_location(places, sql(spark, d, "SELECT s_suppkey AS k, s_nationkey AS city FROM supplier"), "k", "city", ["lat"]), 4, "lat")


CASES = "SELECT event_type AS area, ts, count(*) OVER (PARTITION BY event_type ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS total FROM events"


@query("WITH w AS (SELECT event_type AS a, CAST(date_trunc('week', ts) AS DATE) AS wk, count(*) AS n FROM events WHERE event_type <> 'error' GROUP BY 1, 2) SELECT CASE WHEN a = 'view' THEN 'click' ELSE a END AS area, wk, CAST(sum(n) AS BIGINT) AS new_cases FROM w GROUP BY 1, 2")
def l51_weekly_cases(spark, d):
    totals = sql(spark, d, CASES).groupBy("area", "ts").agg(F.max("total").alias("total"))
    return E.weekly_cases(totals, "area", "ts", "total", {"view": "click"}, ["error"])


@query("""WITH a AS (SELECT user_id % 50 AS k, CAST(ts AS DATE) AS day FROM events WHERE event_type = 'click'), b AS (SELECT user_id % 50 AS k, CAST(ts AS DATE) AS day FROM events WHERE event_type = 'view' AND ts < TIMESTAMP '2024-01-20'), l AS (SELECT least((SELECT max(day) FROM a), (SELECT max(day) FROM b)) AS last)
SELECT coalesce(x.k, y.k) AS k, coalesce(x.n, 0) AS left_n, coalesce(y.n, 0) AS right_n FROM (SELECT k, count(*) AS n FROM a, l WHERE day <= last GROUP BY k) x FULL JOIN (SELECT k, count(*) AS n FROM b, l WHERE day <= last GROUP BY k) y ON x.k = y.k""")
def l52_case_comparison(spark, d):
    day = "SELECT user_id % 50 AS k, CAST(ts AS DATE) AS day, 1 AS n FROM events WHERE event_type = "
    return E.case_comparison(sql(spark, d, day + "'click'"), sql(spark, d, day + "'view' AND ts < TIMESTAMP '2024-01-20'"), ["k"], "day", "n")


@query("""WITH s AS (SELECT yr, sic, CAST(sum(net_income) AS DOUBLE) / CAST(sum(sum(revenue)) OVER (PARTITION BY yr) AS DOUBLE) AS share FROM company_years GROUP BY yr, sic)
SELECT yr, sic, round(share, 8) AS share, round(share - lag(share) OVER (PARTITION BY sic ORDER BY yr), 8) AS change, coalesce(abs(share - lag(share) OVER (PARTITION BY sic ORDER BY yr)) > 0.0005, FALSE) AS jumped FROM s""")
def l53_income_shares(spark, d):
    return rounded(E.income_shares(years_of(spark, d), "yr", "sic", "net_income", "revenue", 0.0005), 8, "share", "change")


@query("""SELECT n_regionkey, coalesce(a.n, 0) AS parts, coalesce(b.n, 0) AS total, abs(coalesce(a.n, 0) - coalesce(b.n, 0)) <= 0 AS ties FROM (SELECT n_regionkey, count(*) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1) a
 FULL JOIN (SELECT n_regionkey, count(*) AS n FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey WHERE o_orderkey % 3 <> 0 GROUP BY 1) b USING (n_regionkey)""")
def l54_hierarchy_ties(spark, d):
    parts = sql(spark, d, "SELECT n_regionkey, 1 AS n FROM customer JOIN nation ON c_nationkey = n_nationkey")
    totals = sql(spark, d, "SELECT n_regionkey, count(*) AS n FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey WHERE o_orderkey % 3 <> 0 GROUP BY 1")
    return E.hierarchy_ties(parts, totals, "n_regionkey", "n", 0)


@query("""SELECT a.form, count(*) AS n, count(*) FILTER (WHERE a.val <> b.val) AS changed, round(median(abs(b.val / a.val - 1) * 100), 6) AS median_pct, round(max(abs(b.val / a.val - 1)) * 100, 6) AS max_pct, arg_max(a.id, row(abs(b.val / a.val - 1) * 100, a.id)) AS "where"
 FROM landings a JOIN landings b ON a.id = b.id AND a.run_id = 'r1' AND b.run_id = 'r2' GROUP BY a.form""")
def l55_file_vintage_diff(spark, d):
    rows = table(spark, d, "landings")
    return rounded(E.file_vintage_diff(rows.filter("run_id = 'r1'"), rows.filter("run_id = 'r2'"), ["id"], ["form"], "val"), 6, "median_pct", "max_pct")


@query("""SELECT yr, CASE WHEN revenue < 500000 THEN 'low' WHEN revenue < 1000000 THEN 'middle' ELSE 'high' END AS band, count(*) AS n, CAST(sum(revenue) AS DECIMAL(30,2)) AS total, round(CAST(sum(revenue) AS DOUBLE) / CAST(sum(sum(revenue)) OVER (PARTITION BY yr) AS DOUBLE), 6) AS share FROM company_years GROUP BY 1, 2""")
def l56_band_shares(spark, d):
    return rounded(E.band_shares(years_of(spark, d), ["yr"], "revenue", [(500_000, "low"), (1_000_000, "middle")], "high"), 6, "share").withColumn("total", F.col("total").cast("decimal(30,2)"))


@query("""WITH p AS (SELECT trim(regexp_replace(lower(p_brand || ' & Co'), '[^a-z0-9]+', ' ', 'g')) AS name, list_has_any(string_split(p_name, ' '), ['cold', 'hot', 'green']) AS has FROM part)
SELECT name, CASE WHEN regexp_matches(name, '^brand 1') THEN 'first' WHEN regexp_matches(name, '^brand [23]') THEN 'second' ELSE 'other' END AS firm, count(*) AS n, count(*) FILTER (WHERE has) AS credentialed, CASE WHEN count(*) < 10 THEN 'small' WHEN count(*) < 50 THEN 'middle' ELSE 'large' END AS size_class FROM p GROUP BY name""")
def l57_preparers(spark, d):
    rows = table(spark, d, "part").select(F.concat("p_brand", F.lit(" & Co")).alias("brand"), F.regexp_replace("p_name", " ", ", ").alias("words"))
    return E.preparers(rows, "brand", "words", {"first": "^brand 1", "second": "^brand [23]"}, ["cold", "hot", "green"], [(10, "small"), (50, "middle")], "large")


@query(f"SELECT ticker, year(m) AS y, round(max(v) FILTER (WHERE month(m) <= 4) / min(v) FILTER (WHERE month(m) BETWEEN 6 AND 10), 6) AS ratio, count(*) AS months FROM {MONTHLY} GROUP BY 1, 2")
def l58_seasonality(spark, d):
    return rounded(E.seasonality(months_of(spark, d), ["ticker"]), 6, "ratio")


@query("SELECT concept, end_date, count(DISTINCT abs(val)) AS n_values, arg_max(val, row(filed, accession, val)) AS latest, count(DISTINCT abs(val)) > 1 AS two_values FROM facts WHERE cik = 7 GROUP BY concept, end_date")
def l59_company_profile(spark, d):
    return E.company_profile(table(spark, d, "facts"), 7)


PATTERNS = {"figure": "([0-9]{1,3}[.][0-9]+)", "percent": "([0-9]+) ?%", "year": "(?:^|[^0-9])((?:19|20)[0-9]{2})(?:[^0-9]|$)", "address": "([a-z]+)@[a-z]+[.]"}


@query(" UNION ALL ".join(f"SELECT doc_id, '{n}' AS pattern, CAST(len(x) AS INTEGER) AS n, x[1] AS first FROM (SELECT doc_id, regexp_extract_all(text, '{p}', 1) AS x FROM documents) WHERE len(x) > 0" for n, p in PATTERNS.items()))
def l60_mine_text(spark, d):
    return E.mine_text(table(spark, d, "documents"), "doc_id", "text", PATTERNS)


@query("""SELECT yr, slice, count(*) AS n, round(CAST(sum(CASE WHEN net_income > 0 THEN revenue ELSE 0 END) AS DOUBLE) / CAST(sum(revenue) AS DOUBLE), 6) AS used, count(*) FILTER (WHERE (net_income > 0) <> (cik % 2 = 0)) AS differs FROM (SELECT *,
 CAST(least(floor(CAST(sum(revenue) OVER (PARTITION BY yr ORDER BY revenue, cik ROWS UNBOUNDED PRECEDING) AS DOUBLE) / CAST(sum(revenue) OVER (PARTITION BY yr) AS DOUBLE) * 20), 19) AS INTEGER) AS slice FROM company_years) GROUP BY yr, slice""")
def l61_survey_groups(spark, d):
    rows = years_of(spark, d).withColumns({"answer": F.col("net_income") > 0, "flag": F.col("cik") % 2 == 0})
    return rounded(E.survey_groups(rows, ["yr"], ["revenue", "cik"], "revenue", "answer", "flag", 20), 6, "used")


@query("""SELECT sic, yr, count(*) AS firms, quantile_disc(CAST(revenue AS DOUBLE), 0.5) AS med, quantile_disc(CAST(revenue AS DOUBLE), 0.9) AS p90, count(*) FILTER (WHERE revenue < 500000) AS small, round(count(*) FILTER (WHERE net_income < 0) / count(*), 6) AS losing, round(count(*) FILTER (WHERE cik % 3 = 0) / count(*), 6) AS fee,
 round(count(*) FILTER (WHERE (net_income < 0) <> (cik % 3 = 0)) / count(*), 6) AS only_one FROM company_years GROUP BY sic, yr""")
def l62_adviser_table(spark, d):
    return rounded(E.adviser_table(years_of(spark, d), ["sic", "yr"], "revenue", {"losing": "net_income < 0", "fee": "cik % 3 = 0"}, 500_000), 6, "losing", "fee", "only_one")


@query(f"""WITH m AS (SELECT yr, macro, macro / orders AS prices FROM ({ECONOMY})), e AS (SELECT a.yr, a.macro / b.macro - 1 AS e, a.prices / b.prices - 1 AS i FROM m a JOIN m b ON a.yr = b.yr + 1),
p AS (SELECT a.yr, e.e, e.i, a.revenue, b.revenue AS before, CAST(a.revenue AS DOUBLE) / CAST(b.revenue AS DOUBLE) - 1 AS g, CAST(a.revenue AS DOUBLE) / CAST(b.revenue AS DOUBLE) / (1 + e.i) - 1 AS r FROM company_years a JOIN company_years b ON a.cik = b.cik AND a.yr = b.yr + 1 JOIN e ON e.yr = a.yr)
SELECT yr, count(*) AS pairs, round(count(*) FILTER (WHERE g > e) / count(*), 6) AS beat, round(quantile_cont(g, 0.25), 6) AS q1, round(quantile_cont(g, 0.75), 6) AS q3, round(CAST(sum(revenue) AS DOUBLE) / CAST(sum(before) AS DOUBLE) - 1, 6) AS aggregate, round(median(r), 6) AS real_median,
 round(count(*) FILTER (WHERE r > 0) / count(*), 6) AS real_up, round(CAST(sum(revenue) AS DOUBLE) / CAST(sum(before) AS DOUBLE) / (1 + any_value(i)) - 1, 6) AS real_aggregate FROM p GROUP BY yr""")
def l63_growth_vs_economy(spark, d):
    macro = sql(spark, d, ECONOMY).select("yr", "macro", (F.col("macro") / F.col("orders")).alias("prices"))
    return rounded(E.growth_vs_economy(years_of(spark, d), "cik", "yr", "revenue", macro), 6, "beat", "q1", "q3", "aggregate", "real_median", "real_up", "real_aggregate")


SUMS = "(SELECT sic, yr, CAST(sum(revenue) AS DOUBLE) AS r FROM company_years GROUP BY sic, yr)"
ALL_SUMS = "(SELECT yr, CAST(sum(revenue) AS DOUBLE) AS r FROM company_years GROUP BY yr)"


@query(f"""SELECT a.sic, count(*) AS years, count(*) FILTER (WHERE a.g > t.g) AS beat, round(exp(sum(ln(a.g) - ln(t.g))), 6) AS relative FROM (SELECT n.sic, n.yr, n.r / p.r AS g FROM {SUMS} n JOIN {SUMS} p ON p.sic = n.sic AND n.yr = p.yr + 1) a
 JOIN (SELECT n.yr, n.r / p.r AS g FROM {ALL_SUMS} n JOIN {ALL_SUMS} p ON n.yr = p.yr + 1) t ON t.yr = a.yr GROUP BY a.sic""")
def l64_sector_scorecard(spark, d):
    return rounded(E.sector_scorecard(years_of(spark, d), "sic", "yr", "revenue"), 6, "relative")


TOTALS = "SELECT yr, count(*) AS people, count(CASE WHEN net_income > 0 THEN 1 END) AS employed, CAST(sum(revenue) AS DOUBLE) AS output FROM company_years GROUP BY yr"


@query(f"SELECT a.yr AS first, b.yr AS last, round(ln(b.people) - ln(a.people), 6) AS people, round(ln(b.employed / b.people) - ln(a.employed / a.people), 6) AS employed_share, round(ln(b.output / b.employed) - ln(a.output / a.employed), 6) AS output FROM ({TOTALS}) a JOIN ({TOTALS}) b ON (a.yr, b.yr) IN ((1996, 1998), (1998, 2000), (1996, 2000))")
def l65_decompose_growth(spark, d):
    return rounded(E.decompose_growth(sql(spark, d, TOTALS), "yr", "people", "employed", "output", [(1996, 1998), (1998, 2000), (1996, 2000)]), 6, "people", "employed_share", "output")


@query("SELECT fy, round(f / total, 6) AS f_share, round(o / total, 6) AS o_share, round(p / total, 6) AS p_share, abs(total - f - o - p) <= 0.001 * total AS adds_up FROM raw_years")
def l66_spending_shares(spark, d):
    return rounded(E.spending_shares(table(spark, d, "raw_years"), "fy", "total", ["f", "o", "p"]), 6, "f_share", "o_share", "p_share")


PARTS = "SELECT cik, CAST(year(end_date) AS INTEGER) AS yr, cik % 5 AS sector, sum(CASE WHEN concept IN ('AF', 'NF') THEN CAST(val AS DECIMAL(14,2)) END) AS a, sum(CASE WHEN concept = 'NO' THEN CAST(val AS DECIMAL(14,2)) END) AS b, sum(CAST(val AS DECIMAL(14,2))) AS total FROM facts GROUP BY 1, 2, 3"


@query(f"SELECT yr, sector, count(*) AS n, round(CAST(sum(a) AS DOUBLE) / CAST(sum(a + b) AS DOUBLE), 6) AS foreign_share FROM ({PARTS}) WHERE abs(total - a - b) <= 0.01 * abs(total) GROUP BY 1, 2")
def l67_foreign_share(spark, d):
    return rounded(E.foreign_share(sql(spark, d, PARTS), ["yr", "sector"], "a", "b", "total", 0.01), 6, "foreign_share")


FLOWS = "SELECT CAST(year(l_shipdate) AS INTEGER) AS year, s_nationkey AS origin, c_nationkey AS dest, CAST(sum(CAST(l_extendedprice AS DECIMAL(14,2))) AS DECIMAL(24,2)) AS v FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2, 3"
GDP = "SELECT CAST(year(o_orderdate) AS INTEGER) AS year, c_nationkey AS place, CAST(sum(CAST(o_totalprice AS DECIMAL(14,2))) AS DECIMAL(24,2)) AS gdp FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2"


@query(f"""WITH f AS ({FLOWS}), g AS ({GDP}), y AS (SELECT max(year) AS year FROM f WHERE year IN (SELECT year FROM g)), n AS (SELECT f.* FROM f JOIN y ON y.year = f.year),
o AS (SELECT origin AS place, count(DISTINCT dest) AS partners, sum(v) AS e, arg_max(dest, row(v, dest)) AS largest, max(v) AS top FROM n GROUP BY 1), i AS (SELECT dest AS place, sum(v) AS i FROM n GROUP BY 1)
SELECT coalesce(o.place, i.place) AS place, coalesce(partners, 0) AS partners, CAST(coalesce(e, 0) AS DECIMAL(34,2)) AS exports, CAST(coalesce(e, 0) - coalesce(i, 0) AS DECIMAL(34,2)) AS balance, round(CAST(coalesce(e, 0) AS DOUBLE) / CAST(gdp AS DOUBLE), 6) AS openness, largest, round(CAST(top AS DOUBLE) / CAST(e AS DOUBLE), 6) AS largest_share
FROM o FULL JOIN i ON o.place = i.place LEFT JOIN (SELECT g.* FROM g JOIN y ON y.year = g.year) g ON g.place = coalesce(o.place, i.place)""")
def l68_trade_flows(spark, d):
    out = E.trade_flows(kept(sql(spark, d, FLOWS)), kept(sql(spark, d, GDP)))
    return rounded(out, 6, "openness", "largest_share").withColumns({c: F.col(c).cast("decimal(34,2)") for c in ("exports", "balance")})


@query(f"SELECT a.ticker, a.m, round(a.v / b.v * 100, 6) AS idx FROM {MONTHLY} a JOIN (SELECT ticker, avg(v) AS v FROM {MONTHLY} WHERE year(m) = 1995 GROUP BY ticker) b ON a.ticker = b.ticker")
def l69_index_base(spark, d):
    return rounded(E.index_base(months_of(spark, d), ["ticker"], 1995), 6, "idx")


@query("""SELECT fy, f - o AS balance, (f - o) - lag(f - o) OVER w AS change, coalesce(abs(f / nullif(lag(f) OVER w, 0) - 1) > 0.1 AND abs(o / nullif(lag(o) OVER w, 0) - 1) > 0.1, FALSE) AS jump FROM raw_years WINDOW w AS (ORDER BY fy)""")
def l70_fiscal_series(spark, d):
    return E.fiscal_series(table(spark, d, "raw_years"), "fy", "f", "o", 0.1)


@query("""SELECT concept, count(*) AS trades, quantile_cont(filed - end_date, 0.5) AS med_lag, quantile_cont(filed - end_date, 0.9) AS p90_lag, count(DISTINCT accession) AS filings, count(DISTINCT CASE WHEN owners > 1 THEN accession END) AS joint
 FROM (SELECT f.*, j.owners FROM facts f JOIN (SELECT accession AS a, count(DISTINCT cik) AS owners FROM facts GROUP BY 1) j ON j.a = f.accession) GROUP BY concept""")
def l71_insider_stats(spark, d):
    return E.insider_stats(table(spark, d, "facts"), "concept")


LISTED = "SELECT s_suppkey, 'CUSTOMER ' || lpad(CAST(s_suppkey AS VARCHAR(10)), 9, '0') AS c_name FROM supplier WHERE s_suppkey % 2 = 0 UNION ALL SELECT s_suppkey + 1, 'Customer-' || lpad(CAST(s_suppkey AS VARCHAR(10)), 9, '0') FROM supplier WHERE s_suppkey % 6 = 0"


@query("""SELECT c_custkey, 'customer ' || split_part(c_name, '#', 2) AS norm, CASE WHEN k % 2 = 0 AND k % 6 <> 0 THEN k END AS s_suppkey, CASE WHEN k IS NULL OR k % 2 = 1 THEN 'unknown' WHEN k % 6 = 0 THEN 'ambiguous' END AS problem
 FROM customer LEFT JOIN (SELECT s_suppkey AS k FROM supplier) ON k = CAST(split_part(c_name, '#', 2) AS BIGINT)""")
def l72_crosswalk(spark, d):
    return E.crosswalk(table(spark, d, "customer").select("c_custkey", "c_name"), sql(spark, d, LISTED), "c_name", "s_suppkey").drop("c_name")


@query("""SELECT year(o_orderdate) AS y, CASE WHEN o_totalprice < 50000 THEN 'low' WHEN o_totalprice < 200000 THEN 'middle' ELSE 'high' END AS band, count(*) AS n, count(*) FILTER (WHERE o_orderstatus = 'F') AS enforced, round(count(*) FILTER (WHERE o_orderstatus = 'F') / count(*), 6) AS rate FROM orders GROUP BY 1, 2""")
def l73_merger_stats(spark, d):
    return rounded(E.merger_stats(table(spark, d, "orders"), F.year("o_orderdate"), "o_totalprice", [(50_000, "low"), (200_000, "middle")], "high", "o_orderstatus = 'F'"), 6, "rate")


WATCH = "SELECT DISTINCT ticker FROM prices UNION SELECT 'GONE' AS ticker"


@query(f"""SELECT w.ticker, coalesce(p.n, 0) AS n, p.a, p.b, coalesce(r.n, 0) AS ref_n, coalesce(r.splits, 0) AS splits, coalesce(r.dividends, 0) AS dividends FROM ({WATCH}) w LEFT JOIN (SELECT ticker, count(*) AS n, min(obs_date) AS a, max(obs_date) AS b FROM prices GROUP BY ticker) p ON p.ticker = w.ticker
 LEFT JOIN (SELECT ticker, count(*) AS n, count(*) FILTER (WHERE split_factor <> 1) AS splits, count(*) FILTER (WHERE div_cash > 0) AS dividends FROM ref_prices GROUP BY ticker) r ON r.ticker = w.ticker""")
def l74_price_population(spark, d):
    return E.price_population(table(spark, d, "prices"), table(spark, d, "ref_prices"), sql(spark, d, WATCH))


@query("""WITH p AS (SELECT sic % 5 AS region, cik, yr, net_income AS v, cik AS w FROM company_years WHERE NOT (cik % 6 = 0 AND yr = 1998)), f AS (SELECT * FROM p WHERE cik IN (SELECT cik FROM p GROUP BY cik HAVING count(DISTINCT yr) = (SELECT count(DISTINCT yr) FROM p)))
SELECT coalesce(CAST(region AS VARCHAR), 'world') AS region, yr, round(CAST(sum(v * w) AS DOUBLE) / CAST(sum(w) AS DOUBLE), 4) AS weighted FROM f GROUP BY GROUPING SETS ((region, yr), (yr))""")
def l75_regional_mean(spark, d):
    """Over companies with a value in every year; a sixth of them lack one."""
    rows = kept(years_of(spark, d).filter("NOT (cik % 6 = 0 AND yr = 1998)").select((F.col("sic") % 5).alias("region"), "cik", "yr", F.col("net_income").alias("v"), F.col("cik").alias("w")))
    return rounded(E.regional_mean(rows, ["yr"], "region", "v", "w", "world", "cik"), 4, "weighted")


ADDRESSES = "SELECT '{\"home\":\"' || CAST(c_nationkey AS VARCHAR(3)) || '\",\"office\":\"' || CAST((c_nationkey + c_custkey) % 27 AS VARCHAR(3)) || '\"}' AS addresses FROM customer"


@query("SELECT a.n_name AS home, coalesce(b.n_name, CAST((c_nationkey + c_custkey) % 27 AS VARCHAR)) AS office, count(*) AS n FROM customer JOIN nation a ON c_nationkey = a.n_nationkey LEFT JOIN nation b ON (c_nationkey + c_custkey) % 27 = b.n_nationkey GROUP BY 1, 2")
def l76_domicile_matrix(spark, d):
    return E.domicile_matrix(sql(spark, d, ADDRESSES), sql(spark, d, "SELECT CAST(n_nationkey AS VARCHAR(3)) AS code, n_name AS name FROM nation"), "addresses")


@query(f"SELECT count(*) AS n, count(*) FILTER (WHERE abs(q.v / y.v - 1) > 0.05) AS off FROM ({YEARS}) y JOIN (SELECT cik, concept, year(q) AS yr, sum(v) AS v FROM ({QUARTERS}) z GROUP BY 1, 2, 3 HAVING count(*) = 4) q ON q.cik = y.cik AND q.concept = y.concept AND q.yr = y.yr")
def l77_annual_tie(spark, d):
    return L.annual_tie(sql(spark, d, QUARTERS), sql(spark, d, YEARS), ["cik", "concept"], 0.05)


@query(f"""SELECT cik, best_a, best_b, CASE WHEN best_a < best_b THEN 'a_first' WHEN best_a > best_b THEN 'b_first' ELSE 'same' END AS "order", best_a IN (lo, hi) OR best_b IN (lo, hi) AS censored FROM (SELECT cik, arg_max(yr, row(r, yr)) AS best_a, arg_max(yr, row(revenue, yr)) AS best_b, min(yr) AS lo, max(yr) AS hi FROM ({ROA}) GROUP BY cik)""")
def l78_peak_order(spark, d):
    return L.peak_order(sql(spark, d, ROA), "cik", "yr", "r", "revenue")


# Further parts of the analytics above


@query(f"""WITH k AS (SELECT cik, year(end_date) AS yr, concept, end_date FROM facts WHERE year(end_date) BETWEEN 1996 AND 2000), w AS (SELECT cik FROM k GROUP BY cik HAVING count(DISTINCT yr) = 5), c AS (SELECT cik, count(DISTINCT year(end_date)) AS n FROM ({RESTATED}) WHERE year(end_date) BETWEEN 1996 AND 2000 GROUP BY cik),
e AS (SELECT coalesce(c.n, 0) AS years, count(*) AS companies FROM w LEFT JOIN c ON c.cik = w.cik GROUP BY 1) SELECT y AS years, coalesce(companies, 0) AS companies FROM (SELECT unnest(range(6)) AS y) LEFT JOIN e ON e.years = y""")
def l22_years_changed(spark, d):
    facts = table(spark, d, "facts").select("cik", F.year("end_date").alias("yr"))
    return L.years_changed(facts, restated(spark, d).withColumn("yr", F.year("end_date")), "yr", 2000, 5)


@query(f"""WITH r AS (SELECT * FROM company_years WHERE cik IN (SELECT cik FROM ({ROA}) WHERE yr = 1996 AND r > -0.02)), b AS (SELECT sic, count(*) AS n, sum(revenue) AS capital, CAST(sum(net_income) AS DOUBLE) / CAST(sum(revenue) AS DOUBLE) AS ret FROM r WHERE yr = 1996 GROUP BY sic), e AS (SELECT sic, count(*) AS n, CAST(sum(net_income) AS DOUBLE) / CAST(sum(revenue) AS DOUBLE) AS ret FROM r WHERE yr = 2001 GROUP BY sic)
SELECT b.sic, b.n, CAST(b.capital AS DECIMAL(34,2)) AS capital, round(CAST(b.capital AS DOUBLE) / (SELECT CAST(sum(capital) AS DOUBLE) FROM b), 8) AS share, round(b.ret, 8) AS ret, e.n AS exit_n, round(e.ret, 8) AS exit_ret FROM b LEFT JOIN e ON e.sic = b.sic ORDER BY b.capital DESC, b.sic LIMIT 7""")
def l32_top_industries(spark, d):
    members = sql(spark, d, ROA).filter("yr = 1996 AND r > -0.02")
    out = L.top_industries(years_of(spark, d), members, "cik", "sic", "yr", "net_income", "revenue", 1996, 2001, 7)
    return rounded(out, 8, "share", "ret", "exit_ret").withColumn("capital", F.col("capital").cast("decimal(34,2)"))


@query(f"WITH RECURSIVE {WALK}, l AS (SELECT o, arg_max(cur, steps) AS survivor, max(steps) AS steps FROM walk GROUP BY o) SELECT survivor, l.o AS member, e.a AS acquirer, CAST(steps AS BIGINT) AS steps FROM l JOIN edges e ON e.o = l.o WHERE survivor IN (SELECT survivor FROM l GROUP BY survivor HAVING count(*) >= 3)")
def l48_tree_rows(spark, d):
    edges = table(spark, d, "edges")
    return E.tree_rows(E.lineage(edges), edges, 3)


AREA_COUNTS = "SELECT event_type AS area, CAST(ts AS DATE) AS day, count(*) AS n FROM events GROUP BY 1, 2 UNION ALL SELECT 'clicks and views', CAST(ts AS DATE), count(*) + CASE WHEN day(ts) = 9 THEN 1 ELSE 0 END FROM events WHERE event_type IN ('click', 'view') GROUP BY CAST(ts AS DATE), day(ts)"


@query("SELECT 'clicks and views' AS division, CAST(ts AS DATE) AS day, count(*) + 1 AS own, count(*) AS parts FROM events WHERE event_type IN ('click', 'view') AND day(ts) = 9 GROUP BY CAST(ts AS DATE)")
def l51_division_gaps(spark, d):
    divisions = spark.createDataFrame([("clicks and views", "click"), ("clicks and views", "view")], "division string, member string")
    return E.division_gaps(sql(spark, d, AREA_COUNTS), divisions, "area", ["day"], "n")


@query("SELECT CAST(date_trunc('month', ts) AS DATE) AS m, count(*) FILTER (WHERE event_id % 5 > 0) AS total, count(DISTINCT CASE WHEN event_id % 5 > 0 THEN event_type END) AS areas, count(DISTINCT CASE WHEN event_id % 5 > 0 THEN user_id END) AS places FROM events GROUP BY 1")
def l52_monthly_breadth(spark, d):
    rows = sql(spark, d, "SELECT ts, event_type, user_id, CASE WHEN event_id % 5 > 0 THEN 1 ELSE 0 END AS v FROM events")
    return E.monthly_breadth(rows, "ts", "event_type", "user_id", "v")


@query("SELECT y, count(*) AS places, count(*) FILTER (WHERE n >= 12) AS over FROM (SELECT year(ts) AS y, user_id, count(*) AS n FROM events GROUP BY 1, 2) GROUP BY y")
def l52_yearly_places(spark, d):
    return E.yearly_places(table(spark, d, "events").withColumn("v", F.lit(1)), "ts", "user_id", "v", 12)


@query(f"SELECT yr, round(quantile_cont(r, 0.1), 8) AS p10, round(quantile_cont(r, 0.5), 8) AS p50, round(quantile_cont(r, 0.9), 8) AS p90 FROM ({ROA}) GROUP BY yr")
def l53_share_deciles(spark, d):
    return rounded(E.share_deciles(sql(spark, d, ROA), "yr", "r"), 8, "p10", "p50", "p90")


@query("""SELECT a.yr, CAST(a.v AS DECIMAL(30,2)) AS bands, CAST(b.v AS DECIMAL(30,2)) AS national, CAST(a.v - b.v AS DECIMAL(30,2)) AS gap FROM (SELECT yr, sum(revenue) AS v FROM company_years GROUP BY yr) a
 FULL JOIN (SELECT CAST(year(l_shipdate) AS INTEGER) AS yr, sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS v FROM lineitem WHERE NOT (year(l_shipdate) = 1999 AND l_linenumber = 7) GROUP BY 1) b ON a.yr = b.yr""")
def l56_band_ties(spark, d):
    bands = E.band_shares(years_of(spark, d), ["yr"], "revenue", [(500_000, "low"), (1_000_000, "middle")], "high")
    national = sql(spark, d, "SELECT CAST(year(l_shipdate) AS INTEGER) AS yr, sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS v FROM lineitem WHERE NOT (year(l_shipdate) = 1999 AND l_linenumber = 7) GROUP BY 1")
    return E.band_ties(bands, ["yr"], national, "v").withColumns({c: F.col(c).cast("decimal(30,2)") for c in ("bands", "national", "gap")})


@query("""WITH p AS (SELECT p_size % 12 AS st, CASE WHEN p_partkey % 4 = 0 THEN [] ELSE string_split(p_name, ' ') END AS l FROM part) SELECT p.st, count(*) AS preparers, count(*) FILTER (WHERE list_contains(l, 'cold')) AS has_cold, count(*) FILTER (WHERE list_contains(l, 'green')) AS has_green, count(*) FILTER (WHERE len(l) = 0) AS none,
 round(any_value(r.paid) / count(*), 6) AS paid_each FROM p JOIN (SELECT c_nationkey AS st, count(*) AS paid FROM customer WHERE c_nationkey <> 3 GROUP BY 1) r ON r.st = p.st GROUP BY p.st""")
def l57_preparers_by_state(spark, d):
    rows = sql(spark, d, "SELECT p_size % 12 AS st, CASE WHEN p_partkey % 4 = 0 THEN NULL ELSE replace(p_name, ' ', ', ') END AS words FROM part")
    paid = sql(spark, d, "SELECT c_nationkey AS st, count(*) AS paid FROM customer WHERE c_nationkey <> 3 GROUP BY 1")
    return rounded(E.preparers_by_state(rows, "st", "words", ["cold", "green"], paid), 6, "paid_each")


ORDERS_A_MONTH = "SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS m, CAST(count(*) AS DOUBLE) AS v FROM orders GROUP BY 1"
CENSUS = "SELECT CAST(year(o_orderdate) AS INTEGER) AS y, CAST(quarter(o_orderdate) AS INTEGER) AS q, " + ", ".join(f"sum(CASE WHEN (month(o_orderdate) - 1) % 3 = {k} AND o_orderkey % 10 > 0 THEN 1 ELSE 0 END) AS m{k + 1}" for k in range(3)) + " FROM orders GROUP BY 1, 2"


@query("SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS m, CAST(count(*) AS DOUBLE) AS survey, count(*) FILTER (WHERE o_orderkey % 10 > 0) AS census, round(count(*) FILTER (WHERE o_orderkey % 10 > 0) / count(*) - 1, 8) AS gap FROM orders WHERE year(o_orderdate) = 1999 GROUP BY 1")
def l58_survey_against_census(spark, d):
    return rounded(E.survey_against_census(sql(spark, d, ORDERS_A_MONTH), sql(spark, d, CENSUS), 1999), 8, "gap")


@query("SELECT c_mktsegment, count(*) AS areas, count(*) FILTER (WHERE c_acctbal < 0) AS withheld FROM customer GROUP BY 1")
def l58_suppression_counts(spark, d):
    return E.suppression_counts(table(spark, d, "customer"), "c_mktsegment", "c_acctbal < 0")


BY_QUARTER = "SELECT c_nationkey AS st, CAST(quarter(o_orderdate) AS INTEGER) AS q, CASE WHEN c_nationkey % 7 = 0 AND quarter(o_orderdate) = 1 THEN NULL ELSE count(*) END AS n FROM orders JOIN customer ON o_custkey = c_custkey WHERE year(o_orderdate) = 1999 GROUP BY c_nationkey, quarter(o_orderdate)"


@query(f"SELECT a.st, a.n AS high, b.n AS low, round(a.n / b.n, 8) AS ratio FROM ({BY_QUARTER}) a JOIN ({BY_QUARTER}) b ON a.st = b.st AND a.q = 1 AND b.q = 3 WHERE a.n IS NOT NULL AND b.n > 0")
def l58_seasonal_states(spark, d):
    return rounded(E.seasonal_states(sql(spark, d, BY_QUARTER), "st", "q", "n"), 8, "ratio")


@query(f"""{SPANS_SQL}, q AS (SELECT cik, end_date, val, 'reported' AS source, CAST(k AS INTEGER) AS o FROM sp WHERE quarters = 1 UNION ALL SELECT cik, end_date, year - three, 'less_quarters', 2 FROM y WHERE n_all = 3 AND end_date - last BETWEEN 80 AND 100)
SELECT 'revenue' AS item, 'year' AS period, end_date, val, 'reported' AS source FROM sp WHERE cik = 10 AND quarters = 4 AND k UNION ALL SELECT 'revenue', 'quarter', end_date, val, source FROM (SELECT * FROM q WHERE cik = 10 QUALIFY row_number() OVER (PARTITION BY end_date ORDER BY o) = 1)""")
def l59_years_and_quarters(spark, d):
    return E.company_years_and_quarters(tags_of(spark, d), 10, {"revenue": ["Revenues", "Sales"]})


@query("""SELECT CASE WHEN a / n < 150000 THEN 'low' WHEN a / n < 200000 THEN 'middle' ELSE 'high' END AS bucket, count(*) AS firms, CAST(sum(n) AS BIGINT) AS clients, CAST(sum(a) AS DECIMAL(34,2)) AS assets FROM (SELECT o_custkey, count(*) AS n, sum(CAST(o_totalprice AS DECIMAL(14,2))) AS a FROM orders GROUP BY 1) WHERE n >= 5 AND a > 0 GROUP BY 1""")
def l62_adviser_buckets(spark, d):
    firms = sql(spark, d, "SELECT o_custkey, count(*) AS n, sum(CAST(o_totalprice AS DECIMAL(14,2))) AS a FROM orders GROUP BY 1")
    return E.adviser_buckets(firms, "a", "n", [(150_000, "low"), (200_000, "middle")], "high").withColumn("assets", F.col("assets").cast("decimal(34,2)"))


@query("SELECT c_name, n, round(n / (SELECT count(*) FROM orders), 8) AS share, round(a / n, 4) AS each FROM (SELECT c_name, count(*) AS n, sum(CAST(o_totalprice AS DECIMAL(14,2))) AS a FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY c_name) ORDER BY n DESC, c_name LIMIT 12")
def l62_top_firms(spark, d):
    firms = sql(spark, d, "SELECT c_name, count(*) AS n, sum(CAST(o_totalprice AS DECIMAL(14,2))) AS a FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY c_name")
    return rounded(E.top_firms(firms, "c_name", "n", "a", 12), 8, "share").withColumn("each", F.round("each", 4))


@query(f"""WITH e AS (SELECT a.yr, a.macro / b.macro - 1 AS e FROM ({ECONOMY}) a JOIN ({ECONOMY}) b ON a.yr = b.yr + 1), p AS (SELECT a.cik, CAST(a.revenue AS DOUBLE) / CAST(b.revenue AS DOUBLE) - 1 > e.e AS beat FROM company_years a JOIN company_years b ON a.cik = b.cik AND a.yr = b.yr + 1 JOIN e ON e.yr = a.yr WHERE a.yr BETWEEN 1997 AND 2000),
c AS (SELECT cik, count(*) FILTER (WHERE beat) AS beat FROM p GROUP BY cik HAVING count(*) = 4) SELECT b AS beat, count(c.cik) AS members FROM (SELECT unnest(range(5)) AS b) LEFT JOIN c ON c.beat = b GROUP BY b""")
def l64_scorecard_distribution(spark, d):
    return E.scorecard_distribution(years_of(spark, d), "cik", "yr", "revenue", sql(spark, d, ECONOMY).select("yr", "macro"), 1997, 2000)


WORLD_OF = "SELECT year, origin AS place, 'exports' AS direction, sum(v) AS v FROM ({flows}) a GROUP BY 1, 2 UNION ALL SELECT year, dest, 'imports', sum(v) FROM ({flows}) b WHERE year < 2001 OR dest > 3 GROUP BY 1, 2"
WORLD = WORLD_OF.format(flows=FLOWS)


@query(f"""WITH w AS ({WORLD}), y AS (SELECT max(year) AS year FROM (SELECT year FROM w GROUP BY year HAVING count(*) = 50)), p AS (SELECT year, origin AS place, 'exports' AS direction, sum(v) AS v FROM ({FLOWS}) WHERE dest % 4 <> 0 GROUP BY 1, 2 UNION ALL SELECT year, dest, 'imports', sum(v) FROM ({FLOWS}) WHERE origin % 4 <> 0 GROUP BY 1, 2)
SELECT w.year, w.place, w.direction, CAST(w.v AS DECIMAL(34,2)) AS total, round(CAST(coalesce(p.v, 0) AS DOUBLE) / CAST(w.v AS DOUBLE), 8) AS covered FROM w JOIN y ON y.year = w.year LEFT JOIN p ON p.year = w.year AND p.place = w.place AND p.direction = w.direction""")
def l68_partner_coverage(spark, d):
    """The flows are summed once and stored: partners and both directions of the world's totals are read from there."""
    path = stored(sql(spark, d, FLOWS))
    flows = spark.read.parquet(path)
    named = flows.filter("dest % 4 <> 0").select("year", F.col("origin").alias("place"), F.lit("exports").alias("direction"), F.col("dest").alias("partner"), "v").unionByName(flows.filter("origin % 4 <> 0").select("year", F.col("dest").alias("place"), F.lit("imports").alias("direction"), F.col("origin").alias("partner"), "v"))
    return rounded(E.partner_coverage(named, sql(spark, d, WORLD_OF.format(flows=f"SELECT * FROM parquet.`{path}`")), 25), 8, "covered").withColumn("total", F.col("total").cast("decimal(34,2)"))


@query("""SELECT 'code' AS kind, CASE WHEN l_returnflag = 'R' THEN '(blank)' ELSE l_returnflag END AS label, count(*) AS n FROM lineitem GROUP BY 1, 2 UNION ALL SELECT 'relationship', coalesce(c_mktsegment, '(blank)'), count(*) FROM customer GROUP BY 1, 2""")
def l71_code_counts(spark, d):
    trades = sql(spark, d, "SELECT CASE WHEN l_returnflag = 'R' THEN ' ' ELSE l_returnflag END AS code FROM lineitem")
    return E.code_counts(trades, table(spark, d, "customer"), "code", "c_mktsegment")


@query(f"""WITH a AS (SELECT cik, q, sum(v) AS v FROM ({QUARTERS}) WHERE concept = 'NO' GROUP BY 1, 2), b AS (SELECT cik, q, sum(v) AS v FROM ({QUARTERS}) WHERE concept IN ('NO', 'RF', 'AF') GROUP BY 1, 2), x AS (SELECT n.cik, n.q, CAST(n.v AS DOUBLE) / nullif(CAST(p.v AS DOUBLE), 0) - 1 AS g FROM a n JOIN a p ON p.cik = n.cik AND n.q = p.q + INTERVAL 1 YEAR), y AS (SELECT n.cik, n.q, CAST(n.v AS DOUBLE) / nullif(CAST(p.v AS DOUBLE), 0) - 1 AS g FROM b n JOIN b p ON p.cik = n.cik AND n.q = p.q + INTERVAL 1 YEAR)
SELECT count(*) AS n, round(corr(x.g, y.g), 6) AS fit, count(*) FILTER (WHERE quarter(x.q) <> 4) AS n_early, round(corr(x.g, y.g) FILTER (WHERE quarter(x.q) <> 4), 6) AS fit_early FROM x JOIN y ON x.cik = y.cik AND x.q = y.q""")
def l77_growth_fit(spark, d):
    rows = sql(spark, d, QUARTERS)
    sums = lambda cs: rows.filter(F.col("concept").isin(cs)).groupBy("cik", "q").agg(F.sum("v").alias("v"))
    return rounded(L.growth_fit(sums(["NO"]), sums(["NO", "RF", "AF"]), ["cik"]), 6, "fit", "fit_early")


@query("""WITH s AS (SELECT yr, CAST(sum(revenue) FILTER (WHERE sic = 3) AS DOUBLE) / CAST(sum(revenue) AS DOUBLE) AS a, CAST(sum(revenue) FILTER (WHERE sic = 11) AS DOUBLE) / CAST(sum(revenue) AS DOUBLE) AS b FROM company_years GROUP BY yr)
SELECT yr, round(coalesce(a, 0), 8) AS share_a, round(coalesce(b, 0), 8) AS share_b, coalesce(a, 0) > coalesce(b, 0) AND NOT coalesce(lag(coalesce(a, 0) > coalesce(b, 0)) OVER (ORDER BY yr), TRUE) AS crossed FROM s""")
def l78_share_crossing(spark, d):
    return rounded(L.share_crossing(years_of(spark, d), "yr", "sic", "revenue", 3, 11), 8, "share_a", "share_b")
