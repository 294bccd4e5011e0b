"""Profile assembly, upsert, read-back, export, cells, catalogue scans, SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import cte, query
from checks.settings import PROFILE
from checks.tag_queries import _LOGIN, _PSM, LINE_SQL, LOG_SQL, ORDER_SQL, USER_SQL
from tagloom import labels as L
from tagloom.operators.cells import from_cells, to_cells
from tagloom.plans import profile as P
from tagloom.plans.tag import project_tags
from tagloom.plans.user_tags import constellation, gender, job, user_tags
from tagloom.sources.catalog import TableSpec, clone_table, scan
from tagloom.session import new_path
from tagloom.sources.sql_functions import register_functions

cte("wide", f"""SELECT * FROM (SELECT id, {', '.join(USER_SQL.values())} FROM fx_users)
    FULL JOIN (SELECT t.*, pay9.paymentCode AS "paymentCode" FROM
      (SELECT cid AS id, {', '.join(ORDER_SQL.values())} FROM o9 GROUP BY cid) t JOIN pay9 ON pay9.cid = t.id) USING (id)
    FULL JOIN (SELECT cid AS id, {', '.join(LINE_SQL.values())} FROM {_PSM.format(9)}) USING (id)
    FULL JOIN (SELECT uid AS id, {', '.join(LOG_SQL.values())}, period AS "ReadedTime_Browser",
      case when logins > 0 then {_LOGIN} end AS "LoginFrequency" FROM gsum JOIN gper USING (uid), gtot) USING (id)
    FULL JOIN (SELECT uid AS id, names AS "ViewGoods" FROM gview) USING (id)""")


def wide(s):
    return P.build_profile(s.users.sparkSession, s, PROFILE)


@query("profile_wide", "SELECT * FROM wide")
def _profile_wide(s):
    return wide(s)


def _columns_sql(names):
    built = {"num", "gender", "job", "marriage", "nationality", "politicalFace", "ageRange", "constellation", "LatestLogin",
             "jiguan", "paymentCode", "ComsumptionAbility", "MaxSingleComsumption", "PerCustomerTransation",
             "purchaseFrequency", "discount", "PriceSensitivity", "device", "browser_loc_url", "LoginFrequency", "ViewFrequency"}
    return ", ".join(f'"{n}"' if n in built else f'cast(null as varchar) AS "{n}"' for n in names)


@query("profile_read", f"SELECT id, {_columns_sql(L.PROFILE_VIEW)} FROM wide")
def _profile_read(s):
    """The console view: every listed column, those of tags not run yet as null."""
    return P.read_view(wide(s))


@query("profile_export", f"SELECT id, {_columns_sql(L.PROFILE_EXPORT)} FROM wide")
def _profile_export(s):
    return P.export_view(wide(s))


@query("profile_upsert", f"""SELECT coalesce(a.id, b.id) AS id, a.job, case when b.id is not null then b.gender else a.gender end AS gender,
    b.paymentCode AS "paymentCode"
    FROM (SELECT id, {USER_SQL['gender']}, {USER_SQL['job']} FROM fx_users WHERE job <> '3') a
    FULL JOIN (SELECT t.id, t.gender, pay9.paymentCode AS "paymentCode" FROM (SELECT id, {USER_SQL['constellation'].replace('AS constellation', 'AS gender')}
      FROM fx_users WHERE job <> '5') t LEFT JOIN pay9 ON pay9.cid = t.id) b ON a.id = b.id""")
def _profile_upsert(s):
    """A profile without some users, updated by columns old and new for all but some users."""
    from checks.settings import ID_DIGITS
    from tagloom.operators.joining import orders_with_id
    from tagloom.plans.order_tags import payment
    from tagloom.plans.tag import single_tag
    profile = project_tags(s.users.where("job <> '3'"), [gender(), job()])
    codes = single_tag(orders_with_id(s.orders, ID_DIGITS), payment())
    update = (project_tags(s.users.where("job <> '5'"), [constellation()])
              .withColumnRenamed("constellation", "gender").join(codes, "id", "left"))
    return P.upsert(profile, update)


@query("explode_cells", """SELECT id, name AS "column", value FROM (
    UNPIVOT (SELECT id, cast(id as varchar) AS k, birthday, gender, job, lastLoginTime AS "lastLoginTime", marriage, nationality,
      politicalFace AS "politicalFace", username FROM fx_users)
    ON k AS 'id', birthday, gender, job, "lastLoginTime", marriage, nationality, "politicalFace", username
    INTO NAME name VALUE value)""")
def _explode_cells(s):
    return to_cells(s.users)


@query("pivot_cells", 'SELECT id, gender, job, lastLoginTime AS "lastLoginTime" FROM fx_users')
def _pivot_cells(s):
    """Cells of two versions: the newer one must win."""
    cells = to_cells(s.users)
    old = cells.withColumn("value", F.lit("stale")).withColumn("ts", F.lit(1))
    versions = cells.withColumn("ts", F.lit(2)).unionByName(old)
    return from_cells(versions, ["gender", "job", "lastLoginTime"])


CUSTOMER_CATALOG = """{"table": {"namespace": "default", "name": "customer"}, "rowkey": "c_custkey", "columns": {
  "id": {"cf": "rowkey", "col": "c_custkey", "type": "Long"},
  "username": {"cf": "cf", "col": "c_name", "type": "string"},
  "balance": {"cf": "cf", "col": "c_acctbal", "type": "double"},
  "neverWritten": {"cf": "cf", "col": "nowhere", "type": "string"}}}"""


def _customer(spark, sf_dir):
    return scan(spark, TableSpec.from_json(CUSTOMER_CATALOG), f"{sf_dir}/customer.parquet")


def _clone(spark, sf_dir):
    """The table is written under a new name and read back."""
    spec = TableSpec.from_json(CUSTOMER_CATALOG)
    two = TableSpec(spec.table, spec.key, spec.columns[:2])
    target = new_path(spark, "customer-clone")
    clone_table(spark, f"{sf_dir}/customer.parquet", target, two, two)
    return scan(spark, two, target)


def register_scans(queries, oracles):
    queries["scan_catalog"] = _customer
    oracles["scan_catalog"] = ('SELECT c_custkey AS id, c_name AS username, c_acctbal AS balance, '
                               'cast(null as varchar) AS "neverWritten" FROM customer')
    queries["table_clone"] = _clone
    oracles["table_clone"] = "SELECT c_custkey AS id, c_name AS username FROM customer"


@query("sql_over_views", """SELECT w.gender, w.job, count(*) AS people, count(DISTINCT o.orderSn) AS orders
    FROM (SELECT id, """ + f"{USER_SQL['gender']}, {USER_SQL['job']}" + """ FROM fx_users) w
    LEFT JOIN o9 o ON o.cid = w.id GROUP BY w.gender, w.job""")
def _sql_over_views(s):
    """Sources and profile are plain tables for SQL."""
    s.register_views(project_tags(s.users, user_tags(PROFILE.as_of).values()))
    return s.users.sparkSession.sql("""
        select p.gender, p.job, count(*) as people, count(distinct o.orderSn) as orders
        from customer_profile p left join tbl_orders o on try_cast(right(o.memberId, 9) as bigint) = p.id
        group by p.gender, p.job""")


cte("seen_products", """SELECT uid, try_cast(regexp_extract(loc_url, '/product/(.*?)\\.html', 1) AS bigint) AS product, log_time FROM g
    WHERE regexp_matches(loc_url, '/product/.*\\.html')""")
cte("seen_lists", """SELECT uid, string_agg(DISTINCT cast(product AS varchar), ',' ORDER BY cast(product AS varchar)) AS list, count(*) AS views,
    max(cast(floor(epoch(log_time)) AS bigint)) AS last FROM seen_products GROUP BY uid""")


@query("sql_functions", """SELECT uid AS id, item, views, trunc(views * 1000.0::double / (SELECT count(*) FROM seen_products)) / 1000.0::double AS share, last
    FROM (SELECT uid, unnest(string_split(list, ',')) AS item, views, last FROM seen_lists)""")
def _sql_functions(s):
    """A program in plain SQL: products out of page addresses, shares, epochs, exploded lists."""
    s.register_views()
    register_functions(s.users.sparkSession)
    return s.users.sparkSession.sql("""
        WITH seen AS (SELECT member_id(global_user_id) AS id, product_id(loc_url) AS product, epoch_of(CAST(log_time AS STRING)) AS at FROM tbl_logs
          WHERE product_id(loc_url) IS NOT NULL AND member_id(global_user_id) IS NOT NULL),
        lists AS (SELECT id, array_join(array_sort(collect_set(product)), ',') AS list, count(*) AS views, max(at) AS last FROM seen GROUP BY id),
        shares AS (SELECT *, (SELECT count(*) FROM seen) AS total FROM lists)
        SELECT s.id, i.item, s.views, share_3_decimals(s.views, s.total) AS share, s.last FROM shares s, LATERAL list_items(s.list) i""")
