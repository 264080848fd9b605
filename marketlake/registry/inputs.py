"""The driver's tables seen as market feeds: raw cards, raw product pages and daily snapshots.

Texts are put together from whole numbers and existing columns only, so that two engines agree on them.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """The wanted columns of one table."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["event_id", "ts", "user_id", "event_type", "value", "props"]
    return table(spark, sf_dir, "events", *columns).selectExpr(
        "event_id",
        "user_id",
        "event_type",
        "ts",
        "cast(floor(value * 100 + 0.5) as bigint) as cents",
        "cast(get_json_object(props, '$.k') as int) as k",
        "concat('P', user_id * 17) as asin",
        "if(user_id % 2 = 0, 'US', 'DE') as marketplace",
        "date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS\") as source_extracted_at",
        "concat('page_', lpad(cast(event_id as string), 12, '0')) as source_file",
        "0 as source_position",
        "cast(cast(ts as date) as string) as ingested_at",
    )


def raw_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Search cards, one per event."""
    return _events(spark, sf_dir).selectExpr(
        "asin",
        "concat('  Card ', event_id, ' ') as title",
        """case when k % 11 = 0 then null when k % 13 = 0 then 'N/A'
                when k % 3 = 0 then concat('VND ', format_number(cents * 10, 0))
                else concat('$', cents div 100, '.', lpad(cast(cents % 100 as string), 2, '0')) end as price""",
        """case when k % 4 = 0 then null
                else concat('$', (cents + k * 7) div 100, '.', lpad(cast((cents + k * 7) % 100 as string), 2, '0'))
           end as original_price""",
        "if(k % 10 = 0, null, concat(k % 4 + 1, '.', k % 10, ' out of 5 stars')) as rating",
        """case when k % 9 = 0 then null when k % 3 = 0 then concat('(', k, '.', event_id % 10, 'K)')
                when k % 7 = 0 then concat('(1,', lpad(cast(k as string), 3, '0'), ')')
                else concat('(', event_id % 1000, ')') end as ratings_count""",
        """case when k % 5 = 0 then null when k % 2 = 0 then concat(k % 9 + 1, 'K+ bought in past month')
                when k % 3 = 0 then concat('1,', lpad(cast(k as string), 3, '0'), '+ bought in past month')
                else concat(k * 10 + 50, '+ bought in past month') end as monthly_sales""",
        "if(k % 17 = 0, null, k % 4 = 0) as is_sponsored",
        "k % 3 = 0 as is_prime",
        "k % 23 = 0 as is_best_seller",
        "k % 19 = 0 as is_amazons_choice",
        """case when k % 6 = 0 then concat('Save ', 5 + k % 20, '%with coupon (some sizes/colors)')
                when k % 6 = 1 then concat('Save $', k, ' with coupon') end as coupon""",
        "concat('FREE delivery in ', k % 7, ' days') as delivery",
        "concat('/dp/', asin) as url",
        "concat('/img/', asin, '.jpg') as image_url",
        """concat(event_type, case user_id % 4 when 0 then ' kit' when 1 then ' kits' when 2 then ' set'
                else '  SETS' end) as keyword""",
        "marketplace",
        "source_extracted_at",
        "source_file",
        "source_position",
        "ingested_at",
    )


def raw_event_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A product page per event, with few of its fields filled: the details feed of the same days as the cards."""
    return _events(spark, sf_dir).selectExpr(
        "asin",
        "concat('Product ', user_id) as title",
        "concat('Brand: B', user_id % 7) as brand",
        "'All > Things' as category",
        "array(concat('#', k + 1, ' in Things')) as best_seller_rank",
        "k % 3 + 1 as variation_count",
        "k % 2 = 0 as is_fba",
        "array(named_struct('name', 'Things', 'url', '/things', 'level', 1)) as categories",
        "marketplace",
        "source_extracted_at",
        "source_file",
        "source_position",
        "ingested_at",
    )


def raw_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product pages, one per order line."""
    columns = ["orderkey", "partkey", "suppkey", "linenumber", "quantity", "extendedprice", "returnflag", "linestatus"]
    lines = table(spark, sf_dir, "lineitem", *[f"l_{c}" for c in columns], "l_shipdate")
    lines = lines.withColumn("q", F.col("l_quantity").cast("int"))
    parts = table(spark, sf_dir, "part", "p_partkey", "p_name", "p_brand", "p_type", "p_size")
    # Lines meet their parts in order of the parts: texts of one part are then next to each other, which compresses.
    return lines.join(parts.hint("merge"), lines.l_partkey == parts.p_partkey).selectExpr(
        "concat('P', l_partkey) as asin",
        "concat('  ', p_name, ' ') as title",
        """case when p_size = 13 then null when p_size = 14 then concat('Visit the ', p_brand, ' Store')
                when p_size = 15 then concat(' Brand: ', p_brand) else concat('Brand:  ', p_brand) end as brand""",
        "concat('All > ', p_type) as category",
        """case p_size % 4 when 0 then null when 1 then cast(array() as array<string>)
                when 2 then array(concat('#', q, ' in ', p_type))
                else array(concat('#1,', lpad(cast(q as string), 3, '0'), ' in ', p_type, chr(10), '(See Top 100 in ', p_name, ')'),
                           concat('#', q, ' in', p_name), 'no rank') end as best_seller_rank""",
        """case when p_size % 6 = 2 then null when p_size % 3 = 0 then concat(q, '.5 x ', p_size, ' x 3.25 inches')
                when p_size % 3 = 1 then concat(q, ' x ', p_size, ' cm') else 'round' end as dimensions""",
        """case when p_size = 20 then null when l_linenumber % 3 = 0 then 'heavy'
                when l_linenumber % 3 = 1 then concat(q, '.25 ounces') else concat(q, ' Fluid ounces ')
           end as weight""",
        """case l_linenumber % 4 when 0 then date_format(l_shipdate, 'MMMM d, yyyy')
                when 1 then concat(' ', date_format(l_shipdate, 'MMM d, yyyy'))
                when 2 then date_format(l_shipdate, 'yyyy-MM-dd')
                else date_format(l_shipdate, 'dd/MM/yyyy') end as date_first_available""",
        "concat('G', l_suppkey) as parent_asin",
        "l_linenumber as variation_count",
        """if(p_size % 7 = 0, null, named_struct('size_name', array_repeat('s', p_size % 5),
                'color_name', array_repeat('c', l_linenumber))) as available_dimensions""",
        "if(p_size % 4 = 0, null, array_repeat(concat('/img/', l_partkey, '.jpg'), p_size % 4 - 1)) as images",
        """case when p_size % 9 = 0 then null
                when p_size % 10 = 0 then named_struct('5', 0, '4', 0, '3', 0, '2', 0, '1', 0)
                else named_struct('5', p_size, '4', q, '3', l_linenumber, '2', cast(null as int), '1', 0)
           end as rating_overview""",
        """case l_linenumber % 3 when 1 then 'In Stock' when 2 then 'Only 3 left in stock' end as stock_status""",
        "concat('S', l_suppkey) as buybox_seller",
        "l_returnflag = 'N' as is_fba",
        """case when p_size = 17 then null
                when p_size = 18 then cast(array() as array<struct<name: string, url: string, level: int>>)
                when p_size % 2 = 0 then array(named_struct('name', 'All', 'url', '/all', 'level', 1),
                        named_struct('name', p_type, 'url', '/t', 'level', 2),
                        named_struct('name', p_name, 'url', '/n', 'level', 3))
                else array(named_struct('name', 'All', 'url', '/all', 'level', 1),
                        named_struct('name', p_type, 'url', '/t', 'level', 2)) end as categories""",
        "if(l_linestatus = 'O', 'US', 'DE') as marketplace",
        """date_format(l_shipdate + make_dt_interval(0, l_linenumber + 7), "yyyy-MM-dd'T'HH:mm:ss")
           as source_extracted_at""",
        """concat_ws('_', lpad(cast(l_orderkey as string), 12, '0'),
                lpad(cast(cast(floor(l_extendedprice * 100 + 0.5) as bigint) as string), 12, '0'),
                l_suppkey, q, l_returnflag) as source_file""",
        "0 as source_position",
        "cast(cast(l_shipdate as date) as string) as ingested_at",
    )


def order_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is known of a customer after each order."""
    columns = ["o_custkey", "o_orderkey", "o_orderdate", "o_orderstatus", "o_orderpriority"]
    return table(spark, sf_dir, "orders", *columns).selectExpr(
        "o_custkey", "o_orderkey", "cast(o_orderdate as date) as day", "o_orderstatus", "o_orderpriority"
    )


def line_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw texts of every kind a card shows, one row per order line."""
    columns = ["l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "l_quantity", "l_discount"]
    lines = table(spark, sf_dir, "lineitem", *columns).selectExpr(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "cast(floor(l_extendedprice * 100 + 0.5) as bigint) as cents",
        "cast(l_quantity as int) as q",
        "cast(floor(l_discount * 100 + 0.5) as int) as d",
    )
    return lines.selectExpr(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "cents",
        """case when q = 7 then null when q = 11 then 'N/A' when l_linenumber = 1
                then concat('VND ', format_number(cents, 0))
                when l_linenumber = 2 then concat('$', format_number(cents div 100, 0), '.',
                        lpad(cast(cents % 100 as string), 2, '0'), ' - $', q, '.99')
                else concat('$', cents div 100, '.', lpad(cast(cents % 100 as string), 2, '0')) end as price""",
        """case when d = 0 then null when d = 10 then '$0.00'
                else concat('EUR ', format_number(cents div (100 - d), 0), '.50') end as original_price""",
        "if(q % 10 = 0, 'no rating', concat(q % 5, '.', d % 10, ' out of 5 stars')) as rating",
        """case l_linenumber when 1 then concat('(', q, '.', d % 10, 'K)') when 2 then concat('(', q, 'm)')
                when 3 then concat('(', format_number(cents, 0), ')') when 4 then cast(q as string)
                when 5 then null else concat('(', l_partkey, ')') end as ratings_count""",
        """case l_linenumber when 1 then concat(q, 'K+ bought in past month')
                when 2 then concat(format_number(cents, 0), '+ bought in past month') when 3 then 'new'
                when 4 then null else concat(l_partkey, '+ bought in past month') end as monthly_sales""",
        """case l_linenumber when 1 then concat('Save ', q, '%with coupon') when 2 then concat('Save $', q, ' now')
                when 3 then concat('Save  ', q, '.5 % today') when 4 then '' end as coupon""",
    )
