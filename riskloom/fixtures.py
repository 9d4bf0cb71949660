"""Inputs for the registered queries, made from the benchmark tables.

Each text is written in the subset that Spark SQL and DuckDB both accept, so the same text builds the
Spark DataFrame and the common table expression of the SQL check. Tables are named in braces. Rows are
derived from the tables' own keys and prices, without random functions. Line items and orders grow with
the data, so they meet in a shuffled merge join, which also spreads the rows over all cores; neither is
ever broadcast. The tasks of that join are numbered by the size of the line items: what is shuffled is narrow, but
every row leaves the join some ten times wider, which adaptive execution does not see when it joins partitions. So this
join comes last: parts, which may need a shuffle of their own, are met before. A table that needs rows brought together
has them dealt while they are narrow as well (``by``).
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of stored line items for each task of the join; about 100,000 transactions.
TASK_BYTES = 2 << 20
LEAST_TASKS = 4

FX_TX = """
WITH k AS (
  SELECT /*+ MERGE(o) */ l_orderkey, l_linenumber, o_custkey, p_type, p_brand, o_orderdate,
    CAST(l_orderkey*7919 + l_partkey*104729 + l_linenumber*1299709 + l_suppkey*31 AS BIGINT) AS h,
    CAST(round(l_extendedprice*100) AS BIGINT) AS cents
  FROM {lineitem} AS l JOIN {orders} AS o ON l_orderkey = o_orderkey JOIN {part} ON l_partkey = p_partkey),
s AS (
  SELECT *, h % 86400 AS sec,
    CAST(floor(cents / (CASE WHEN h%100<60 THEN 400 WHEN h%100<85 THEN 60 WHEN h%100<95 THEN 15 ELSE 4 END)) AS BIGINT) AS ac,
    CASE o_custkey%4 WHEN 0 THEN 'SP' WHEN 1 THEN 'RJ' WHEN 2 THEN 'MG' ELSE 'BA' END AS home,
    CAST(-20 AS DOUBLE) + CAST(h%1499-749 AS DOUBLE)/100 AS plat,
    CAST(-47 AS DOUBLE) + CAST(h%1511-755 AS DOUBLE)/100 AS plon
  FROM k)
SELECT
  'TX' || CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) AS transaction_id,
  'C' || CAST(o_custkey AS STRING) AS customer_id,
  'D' || CAST(o_custkey*3 + h%4 AS STRING) AS device_id,
  substr(CAST(o_orderdate AS STRING),1,10) || 'T' || lpad(CAST(CAST(floor(sec/3600) AS BIGINT) AS STRING),2,'0') || ':' || lpad(CAST(CAST(floor(sec/60) AS BIGINT)%60 AS STRING),2,'0') || ':' || lpad(CAST(sec%60 AS STRING),2,'0') AS event_ts,
  CASE h%5 WHEN 0 THEN 'PIX' WHEN 1 THEN 'CREDIT_CARD' WHEN 2 THEN 'DEBIT_CARD' WHEN 3 THEN 'TED' ELSE 'BOLETO' END AS type,
  CASE WHEN h%211=0 THEN NULL WHEN h%97=0 THEN -CAST(ac AS DOUBLE)/100 ELSE CAST(ac AS DOUBLE)/100 END AS amount,
  'BRL' AS currency,
  CASE WHEN h%7<3 THEN ' mobile_app' WHEN h%7<5 THEN 'WEB_BANKING' WHEN h%7=5 THEN 'ATM ' ELSE 'BRANCH' END AS channel,
  p_brand AS merchant_name,
  p_type AS merchant_category,
  CASE WHEN h%13<6 THEN 'low' WHEN h%13<10 THEN 'medium' WHEN h%13<12 THEN 'high' END AS mcc_risk_level,
  CASE WHEN h%5 IN (1,2) THEN (CASE h%3 WHEN 0 THEN 'Visa' WHEN 1 THEN 'Mastercard' ELSE 'Elo' END) END AS card_brand,
  CASE h%5 WHEN 1 THEN 'CREDIT' WHEN 2 THEN 'DEBIT' END AS card_type,
  CASE WHEN h%5 IN (1,2) THEN (CASE h%11 WHEN 0 THEN 'MANUAL' WHEN 1 THEN 'ONLINE' ELSE 'CHIP' END) END AS card_entry,
  CASE WHEN h%5 IN (1,2) THEN h%17<>0 END AS cvv_validated,
  CASE WHEN h%5 IN (1,2) THEN h%19<16 END AS auth_3ds,
  CASE WHEN h%5=0 THEN (CASE h%9 WHEN 0 THEN 'CPF' WHEN 1 THEN 'EMAIL' ELSE 'PHONE' END) END AS pix_key_type,
  CASE WHEN h%5 IN (0,3) THEN 'BANK' || CAST(h%8 AS STRING) END AS destination_bank,
  CASE WHEN h%23=0 THEN NULL WHEN h%67<56 THEN CAST(h%97 AS DOUBLE) ELSE CAST(h%1009 AS DOUBLE) END AS distance_from_last_txn_km,
  CASE WHEN h%61<48 THEN CAST(h%9 AS INT) ELSE CAST(h%29 AS INT) END AS transactions_last_24h,
  CASE WHEN h%71<58 THEN CAST((h%199)*100 AS DOUBLE) ELSE CAST((h%601)*100 AS DOUBLE) END AS accumulated_amount_24h,
  h%31<3 AS unusual_time,
  h%37<5 AS new_beneficiary,
  CASE WHEN h%41<34 THEN 'APPROVED' WHEN h%41<38 THEN 'DECLINED' WHEN h%41=38 THEN 'PENDING' ELSE 'BLOCKED' END AS status,
  CASE WHEN h%43=0 THEN NULL WHEN h%73<60 THEN CAST(h%48 AS DOUBLE) ELSE CAST(h%101 AS DOUBLE) END AS fraud_score,
  CASE WHEN h%47=0 THEN NULL ELSE h%53<3 END AS is_fraud,
  CASE WHEN h%53<3 AND h%47<>0 THEN (CASE h%3 WHEN 0 THEN 'CARD_CLONING' WHEN 1 THEN 'ACCOUNT_TAKEOVER' ELSE 'PIX_SCAM' END) END AS fraud_type,
  CAST(CASE WHEN h%10<6 THEN 1 ELSE h%13 END AS INT) AS installments,
  plat AS purchase_latitude, plon AS purchase_longitude,
  plat + (CASE WHEN h%79<70 THEN CAST(h%301-150 AS DOUBLE)/100 ELSE CAST(h%1999-999 AS DOUBLE)/40 END) AS device_latitude,
  plon + (CASE WHEN h%79<70 THEN CAST(h%307-153 AS DOUBLE)/100 ELSE CAST(h%2003-1001 AS DOUBLE)/40 END) AS device_longitude,
  home AS customer_home_state,
  CASE WHEN h%59<48 THEN home WHEN h%59<54 THEN 'AM' ELSE 'RS' END AS purchase_state,
  h%83<25 AS had_travel_purchase_last_12m,
  h%89<13 AS is_first_purchase_in_state,
  h%101<5 AS is_international,
  h%103<62 AS is_online,
  CASE WHEN h%107<80 THEN CAST(400 + h%500 AS DOUBLE) ELSE CAST(20 + h%60 AS DOUBLE) END AS avg_transaction_amount_30d,
  CASE WHEN h%109<50 THEN 'electronics' WHEN h%109<60 THEN 'airline_ticket' ELSE 'e-commerce' END AS category
FROM s
"""

FX_CUSTOMERS = """
SELECT 'C' || CAST(c_custkey AS STRING) AS customer_id,
  c_name || CASE WHEN c_custkey%3=0 THEN '  ' ELSE '' END AS full_name,
  lpad(CAST(c_custkey%1000 AS STRING),3,'0') || '.' || lpad(CAST((c_custkey*7)%1000 AS STRING),3,'0') || '.' || lpad(CAST((c_custkey*13)%1000 AS STRING),3,'0') || '-' || lpad(CAST(c_custkey%100 AS STRING),2,'0') AS tax_id,
  CASE WHEN c_custkey%50<>0 THEN ' ' || upper(substr(c_name,1,1)) || CAST(c_custkey AS STRING) || '@Mail.COM' END AS email,
  CAST(CAST(1935 + c_custkey%78 AS INT) AS STRING) || '-0' || CAST(1 + c_custkey%9 AS STRING) || '-15' AS birth_date,
  CASE c_custkey%4 WHEN 0 THEN ' sp' WHEN 1 THEN 'RJ' WHEN 2 THEN 'mg ' ELSE 'BA' END AS state,
  CAST(CASE WHEN c_custkey%61=0 THEN NULL ELSE 1200 + (c_custkey*37)%26000 END AS DOUBLE) AS monthly_income,
  CAST(300 + (c_custkey*17)%600 AS INT) AS credit_score,
  c_custkey%11=0 AS is_premium, c_custkey%97=0 AS pep, c_mktsegment AS segment
FROM {customer}
"""

FX_DEVICES = """
SELECT 'D' || CAST(c_custkey*3 + i AS STRING) AS device_id, 'C' || CAST(c_custkey AS STRING) AS customer_id,
  CASE WHEN (c_custkey+i)%2=0 THEN 'Android' ELSE 'iOS' END AS os_name,
  CASE WHEN (c_custkey+i)%10<>0 THEN CAST(10 + (c_custkey*3+i)%6 AS STRING) END AS os_version,
  CASE WHEN (c_custkey*3+i)%71=0 THEN NULL ELSE (c_custkey*3+i)%19=0 END AS is_rooted,
  (c_custkey*3+i)%29=0 AS is_emulator, (c_custkey*3+i)%6<>0 AS is_trusted,
  CAST((c_custkey*41+i*23)%101 AS INT) AS risk_score
FROM (SELECT c_custkey, 0 AS i FROM {customer} UNION ALL SELECT c_custkey, 1 FROM {customer}
  UNION ALL SELECT c_custkey, 2 FROM {customer}) t
WHERE (c_custkey*3+i)%17<>0
"""

_JOINS = "FROM {lineitem} AS l JOIN {orders} AS o ON l_orderkey = o_orderkey JOIN {part} ON l_partkey = p_partkey"
_LINES = "l_orderkey l_linenumber l_partkey l_suppkey l_extendedprice p_type p_brand".split()

TABLES = {FX_TX: ["lineitem", "orders", "part"], FX_CUSTOMERS: ["customer"], FX_DEVICES: ["customer"]}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fixture(spark: SparkSession, sf_dir: str, text: str, by: str | None = None, **frames: DataFrame) -> DataFrame:
    """The text over the benchmark tables; ``frames`` may replace some of them, by a stream for instance. Rows of
    transactions that have the same ``by``, an expression over line items, orders and parts, are brought together."""
    given = {name: frames[name] if name in frames else table(spark, sf_dir, name) for name in TABLES[text]}
    if text == FX_TX and not frames:
        n = tasks(spark, sf_dir)
        lines = given.pop("lineitem").join(given.pop("part"), F.expr("l_partkey = p_partkey")).select(*_LINES)
        given["lines"] = lines.repartition(n, "l_orderkey")
        given["orders"] = given["orders"].repartition(n, "o_orderkey")
        text = text.replace(_JOINS, "FROM {lines} AS l JOIN {orders} AS o ON l_orderkey = o_orderkey")
    if by:
        text = text.replace("FROM k)", f"FROM (SELECT /*+ REBALANCE(dealt) */ *, {by} AS dealt FROM k))")
    return spark.sql(text, **given)


def tasks(spark: SparkSession, sf_dir: str) -> int:
    """In how many partitions the transactions of a data folder are made."""
    place = spark._jvm.org.apache.hadoop.fs.Path(f"{sf_dir}/lineitem.parquet")
    stored = place.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(place).getLength()
    return max(LEAST_TASKS, -(-stored // TASK_BYTES))


def plain_sql(text: str) -> str:
    """The text with table names in place, for the SQL check."""
    return text.format(**{name: name for name in TABLES[text]})
