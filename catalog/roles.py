"""The shared tables seen as requests, businesses and reviews.

Each role is a list of SQL expressions that Spark and DuckDB read alike; only the repetition of rows
(``copy``) is written per engine. Gaps, spelling variants and copies are put in by key, since the tables
have none; no row is left out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# name: (source table, expression of copies per row or None, {column: expression})
ROLES: dict[str, tuple[str, str | None, dict[str, str]]] = {
    "requests": (
        "orders",
        None,
        {
            "service_request_id": "o_orderkey",
            "service_name": "o_orderpriority",
            "subject": "o_orderstatus",
            "agency_responsible": "'agency ' || o_orderstatus",
            "requested_datetime": "cast(o_orderdate as string)",
            "address": "cast(o_custkey as string) || ' main street'",
            "zipcode": "'19' || lpad(cast(o_orderkey % 54 + 100 as string), 3, '0')",
            "lat": "39.9e0 + ((o_orderkey * 7919) % 10007) / 10007e0 * 0.2e0",
            "lon": "-75.25e0 + ((o_orderkey * 104729) % 10009) / 10009e0 * 0.3e0",
        },
    ),
    "businesses": (
        "customer",
        None,
        {
            "business_id": "c_custkey",
            "name": "c_name",
            "address": "cast(c_nationkey as string) || ' market street'",
            "postal_code": "'19' || lpad(cast(c_custkey % 54 + 100 as string), 3, '0')",
            "latitude": "39.9e0 + ((c_custkey * 15485863) % 10007) / 10007e0 * 0.2e0",
            "longitude": "-75.25e0 + ((c_custkey * 32452843) % 10009) / 10009e0 * 0.3e0",
            "stars": "1e0 + (c_custkey % 9) * 0.5e0",
            "review_count": "c_custkey * 31 % 997",
            "primary_category": "c_mktsegment",
            "categories_normalized": (
                "split(c_mktsegment || '|' || case c_custkey % 4 when 0 then 'Food & Restaurants'"
                " when 1 then 'Shopping & Retail' when 2 then 'Home Services' else 'Pets' end"
                " || case when c_custkey % 6 = 0 then '|Professional Services' else '' end, '|')"
            ),
        },
    ),
    "requests_raw": (
        "orders",
        "case when o_orderkey % 143 = 0 then {1,2,3} when o_orderkey % 11 = 0 then {1,2}"
        " when o_orderkey % 13 = 0 then {1,3} else {1} end",
        {
            "objectid": "copy * 1000000000000 + o_orderkey",
            "service_request_id": "case when copy = 3 then o_orderkey + 1000000000000 else o_orderkey end",
            "subject": "case when o_orderkey % 5 = 0 then null else '  Case' || chr(9) || o_orderstatus end",
            "status": "o_orderstatus",
            "status_notes": "case when o_orderkey % 10 = 0 then null else 'note ' || cast(copy as string) end",
            "service_name": (
                "case when o_orderkey % 19 = 0 then null when o_orderkey % 3 = 0 then lower(o_orderpriority)"
                " when o_orderkey % 3 = 1 then '  ' || o_orderpriority || chr(160)"
                " else replace(o_orderpriority, '-', ' ' || chr(9) || '- ') end"
            ),
            "service_code": "substr(o_orderpriority, 1, 1)",
            "agency_responsible": "'agency ' || o_orderstatus",
            "service_notice": "cast(null as string)",
            "requested_datetime": "cast(o_orderdate as string)",
            "updated_datetime": "cast(o_orderdate as string)",
            "expected_datetime": "cast(null as string)",
            "closed_datetime": "cast(null as string)",
            "address": "cast(o_custkey as string) || ' main street'",
            "zipcode": (
                "case when o_orderkey % 97 = 0 then null when o_orderkey % 89 = 0 then '191-04'"
                " else case o_orderkey % 4 when 0 then '' when 3 then 'PA ' else '' end"
                " || '19' || lpad(cast(o_orderkey % 54 + 100 as string), 3, '0')"
                " || case o_orderkey % 4 when 1 then '.0' when 2 then '-1234' else '' end end"
            ),
            "media_url": "cast(null as string)",
            # third copies lie a few metres off: about half of them still round to the same 4 places
            "lat": (
                "case when o_orderkey % 17 = 0 then null else 39.9e0 + ((o_orderkey * 7919) % 10007) / 10007e0 * 0.2e0"
                " + case when copy = 3 then 5e-5 else 0e0 end end"
            ),
            "lon": "-75.25e0 + ((o_orderkey * 104729) % 10009) / 10009e0 * 0.3e0",
        },
    ),
    "businesses_raw": (
        "customer",
        "case when c_custkey % 11 = 0 then {1,2} else {1} end",
        {
            "Seq No": "copy * 1000000000000 + c_custkey",
            "Business_ID": "c_custkey",
            " Name ": (
                "case c_custkey % 3 when 0 then upper(c_mktsegment) when 1 then ' ' || c_mktsegment else lower(c_mktsegment) end"
                " || ' store ' || cast(c_custkey % 37 as string)"
            ),
            "Address": (
                "case when c_custkey % 23 = 0 then null else cast(c_custkey % 83 as string)"
                " || case c_nationkey % 3 when 0 then ' Market Street' when 1 then ' Walnut street' else ' Broad Ave' end end"
            ),
            "City": "'City ' || cast(c_nationkey as string)",
            "State": "'S' || cast(c_nationkey % 5 as string)",
            "Postal Code": (
                "case when c_custkey % 29 = 0 then null when c_custkey % 27 = 0 then '191-04'"
                " when c_custkey % 26 = 0 then '1910'"
                " else ' 19' || lpad(cast(c_custkey % 154 + 100 as string), 3, '0')"
                " || case c_custkey % 3 when 1 then '.0' when 2 then '-1234' else '' end end"
            ),
            "Latitude": (
                "case when c_custkey % 17 = 0 then null when c_custkey % 31 = 0 then 95e0"
                " when c_custkey % 37 = 0 then 41.2e0 when c_custkey % 41 = 0 then 40.5e0"
                " else 39.9e0 + ((c_custkey * 15485863) % 10007) / 10007e0 * 0.2e0 end"
            ),
            "Longitude": (
                "case when c_custkey % 43 = 0 then null when c_custkey % 47 = 0 then -200e0"
                " else -75.25e0 + ((c_custkey * 32452843) % 10009) / 10009e0 * 0.3e0 end"
            ),
            "Stars": "1e0 + (c_custkey % 9) * 0.5e0",
            "Review Count": "c_custkey * 31 % 997",
            "Is Open?": "copy % 2",
            "Categories": (
                "case when c_custkey % 13 = 0 then null"
                " when c_custkey % 7 = 0 then 'Home Services,  Restaurants & Bars (' || c_mktsegment || ')'"
                " when c_custkey % 5 = 0 then 'Tex-Mex ,Steakhouses, ' || c_mktsegment"
                " when c_custkey % 3 = 0 then 'Nation ' || cast(c_nationkey as string) || ', Zoo, Pet  Stores'"
                " else c_mktsegment end"
            ),
        },
    ),
    "reviews_raw": (
        "documents left join labels using (doc_id)",
        "case when doc_id % 11 = 0 then {1,2} else {1} end",
        {
            "seq": "copy * 1000000000000 + doc_id",
            "review_id": "'r' || cast(doc_id as string)",
            "business_id": "case when doc_id % 53 = 0 then null else lang end",
            "stars": "cast(quality as double)",
            "text": (
                "case when doc_id % 43 = 0 then null when doc_id % 47 = 0 then '!!! ... ---'"
                " when doc_id % 7 = 0 then 'See HTTP://Example.com/a?b=1 now; ' || text || ' (www.example.org/x)' else text end"
            ),
            "date": (
                "case when doc_id % 41 = 0 then null else '2024-' || lpad(cast(doc_id % 12 + 1 as string), 2, '0')"
                " || '-' || lpad(cast(doc_id % 28 + 1 as string), 2, '0') || ' 12:00:00' end"
            ),
            "useful": "n_chars + copy",
        },
    ),
    "reviews": (
        "documents",
        None,
        {
            "review_id": "'r' || cast(doc_id as string)",
            "business_id": "source",
            "text": "text",
            "date": (
                "'2024-' || lpad(cast(doc_id % 12 + 1 as string), 2, '0')"
                " || '-' || lpad(cast(doc_id % 28 + 1 as string), 2, '0') || ' 12:00:00'"
            ),
        },
    ),
    "shops": (
        "part",
        None,
        {
            "shop_id": "p_partkey",
            "name": "p_name",
            # some beyond 62 characters, where the similarity needs several words of bits
            "address": (
                "p_brand || ' ' || p_type || case when p_partkey % 40 = 0"
                " then ' near the corner of the old market square and river road' else '' end"
            ),
            "review_count": "p_size",
        },
    ),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The table; one whose files make fewer scan tasks than there are cores is spread over up to 16.

    Each shared table is one file of one row group, hence one task. Tables of many files stay as read.
    """
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    wanted = min(spark.sparkContext.defaultParallelism, 16)
    return df.repartition(wanted) if df.rdd.getNumPartitions() < wanted else df


def role(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    source, copies, columns = ROLES[name]
    if " join " in source:
        left, right = source.split(" left join ")
        right, key = right.split(" using ")
        df = table(spark, sf_dir, left).join(table(spark, sf_dir, right), key.strip("()"), "left")
    else:
        df = table(spark, sf_dir, source)
    if copies:
        in_spark = copies.replace("{", "array(").replace("}", ")")
        df = df.withColumn("copy", F.explode(F.expr(in_spark)))
    return df.select(*[F.expr(_spark(text)).alias(column) for column, text in columns.items()])


def _spark(text: str) -> str:
    return text.replace("'|')", "'[|]')") if text.startswith("split(") else text


def role_sql(name: str) -> str:
    """The role as a DuckDB subquery in parentheses."""
    source, copies, columns = ROLES[name]
    if copies:
        listed = copies.replace("{", "[").replace("}", "]")
        source = f"(select *, unnest({listed}) as copy from {source})"
    picked = ", ".join(f'{text} as "{column}"' for column, text in columns.items())
    return f"(select {picked} from {source})"
