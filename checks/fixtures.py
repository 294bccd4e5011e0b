"""The four source tables as views over the test tables, for Spark and for DuckDB."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from tagloom.session import DEFAULTS
from tagloom.sources.tables import Sources

SPARK = {"text": "string", "epoch": "cast(unix_timestamp({0}) as bigint)",
         "plus_days": "date_add(date '1948-01-01', cast({0} as int))",
         # orders first: only numbers of a line are shuffled, its names come last
         "lines": "lineitem join orders on o_orderkey = l_orderkey join part on p_partkey = l_partkey"}
DUCKDB = {"text": "varchar", "epoch": "cast(floor(epoch({0})) as bigint)",
          "plus_days": "(date '1948-01-01' + cast({0} as int))",
          "lines": "lineitem join part on p_partkey = l_partkey join orders on o_orderkey = l_orderkey"}


def views(dialect: dict[str, str]) -> dict[str, str]:
    text = dialect["text"]

    def txt(x):
        return f"cast({x} as {text})"

    def epoch(x):
        return dialect["epoch"].format(x)

    def whole(x):
        return txt(f"cast(floor({x}) as bigint)")
    birthday = dialect["plus_days"].format("(c_custkey * 7919) % 29500")
    return {
        "fx_users": f"""
            select c_custkey as id, c_name as username,
              {txt('c_custkey % 4')} as gender, {txt('c_custkey % 8')} as job,
              {txt('c_custkey % 5')} as marriage, {txt('c_custkey % 7')} as nationality,
              {txt('(c_custkey + 1) % 5')} as politicalFace,
              {txt(birthday)} as birthday, {txt('l.t')} as lastLoginTime
            from customer left join (
              select user_id, max({epoch('ts')}) as t from events where event_type = 'signup' group by user_id
            ) l on l.user_id = c_custkey""",
        "fx_orders": f"""
            select o_orderkey as id, '1' || lpad({txt('o_custkey')}, 9, '0') as memberId,
              {txt('o_orderkey')} as orderSn, {txt('o_totalprice')} as orderAmount,
              {txt(epoch('o_orderdate'))} as finishTime, o_orderpriority as paymentCode,
              case o_orderstatus when 'O' then '0' when 'F' then '1' else '2' end as orderStatus,
              case when o_orderpriority = '1-URGENT' then {txt(epoch('o_orderdate'))} else '0' end as smManualTime,
              case o_custkey % 5 when 0 then '716' when 1 then '173' when 2 then '335' when 3 then '271' else '999' end as city
            from orders""",
        "fx_goods": f"""
            select l_orderkey * 16 + l_linenumber as id, {txt('l_orderkey')} as cOrderSn,
              {txt('l_partkey')} as productId, p_name as productName, p_type as productType,
              {txt('p_size')} as cateId,
              case cast(substr(p_brand, 7) as int) % 9 when 0 then '297' when 1 then '298' when 2 then '299'
                when 3 then '301' when 4 then '303' when 5 then '305' when 6 then '0' when 7 then '5' else '999' end as brandId,
              {whole('l_extendedprice / l_quantity')} as price, {txt('cast(l_quantity as bigint)')} as number,
              {whole('case when l_partkey % 10 < o_custkey % 11 then l_extendedprice * (1 - 8 * l_discount) else l_extendedprice * (1 + l_tax) end')} as productAmount,
              {whole('l_extendedprice * l_tax')} as shippingFee,
              case when l_discount >= 0.08 then '9.90' else '0.00' end as activityPrice,
              case when l_discount >= 0.05 then '5.00' else '0.00' end as couponAmount,
              case when l_tax >= 0.06 then '3.00' else '0.00' end as orderPromotionAmount
            from {dialect['lines']}""",
        "fx_logs": f"""
            select event_id as id, {txt('user_id')} as global_user_id, ts as log_time,
              case event_type when 'signup' then 'http://www.eshop.com/login.html'
                when 'click' then 'http://www.eshop.com/c/' || {txt('event_id % 20')}
                when 'view' then 'http://www.eshop.com/product/' || {txt('event_id % 200')} || '.html'
                when 'purchase' then 'http://www.eshop.com/order/' || {txt('event_id')}
                else 'http://m.eshop.com/' end as loc_url,
              case event_id % 4 when 0 then 'http://www.eshop.com/' when 1 then 'http://www.eshop.com/index.html'
                when 2 then 'http://www.eshop.com/c/9' else 'http://other.example.com/' end as ref_url,
              case event_id % 5 when 0 then 'Mozilla/5.0 (Windows NT 10.0)'
                when 1 then 'Mozilla/5.0 (Macintosh; Intel Mac OS X 10_14)'
                when 2 then 'Mozilla/5.0 (Linux; Android 9)'
                when 3 then 'Mozilla/5.0 (iPhone; CPU iPhone OS 12_0)' else 'Mozilla/5.0 (X11; Ubuntu)' end as user_agent
            from events""",
    }


_TABLES = {
    "fx_users": ("customer", "events"),
    "fx_orders": ("orders",),
    "fx_goods": ("lineitem", "part", "orders"),
    "fx_logs": ("events",),
}


def _view(spark: SparkSession, sf_dir: str, name: str, sql: str) -> DataFrame:
    tables = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in _TABLES[name]}
    for table in tables:
        sql = _replace_word(sql, table, "{" + table + "}")
    return spark.sql(sql, **tables)


def _replace_word(sql: str, table: str, new: str) -> str:
    for before in ("from ", "join "):
        sql = sql.replace(f"{before}{table}", f"{before}{new}")
    return sql


class FixtureSources(Sources):
    """The fixture views, each built when a query first asks for it."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        object.__setattr__(self, "_open", lambda name: _view(spark, sf_dir, name, views(SPARK)[name]))
        object.__setattr__(self, "spark", spark)

    users = cached_property(lambda self: self._open("fx_users"))
    orders = cached_property(lambda self: self._open("fx_orders"))
    goods = cached_property(lambda self: self._open("fx_goods"))
    logs = cached_property(lambda self: self._open("fx_logs"))


def sources(spark: SparkSession, sf_dir: str) -> Sources:
    for key in ("spark.sql.session.timeZone", "spark.sql.ansi.enabled"):
        spark.conf.set(key, DEFAULTS[key])
    return FixtureSources(spark, sf_dir)
