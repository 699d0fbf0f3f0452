"""Imagery tables derived from the driver's tables.

The SQL runs unchanged in Spark and in DuckDB; each text reads one table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from skyloom.session import table

SOURCE = {"photos": "part", "boxes": "lineitem", "footprints": "orders", "cameras": "events", "slices": "customer", "bg_candidates": "orders", "disk": "orders"}

SQL = {
    "photos": """select concat('IMG_', cast(p_partkey as string)) as parent_image, p_partkey,
       case when p_partkey % 50 = 0 then 800 else cast(1024 + p_partkey*37 % 3000 as int) end as w,
       cast(1024 + p_partkey*53 % 2000 as int) as h,
       case when p_partkey % 10 = 8 then 'val' when p_partkey % 10 = 9 then 'test' else 'train' end as split
from part""",
    "boxes": """select concat('IMG_', cast(l_partkey as string)) as parent_image, l_partkey, l_orderkey, l_linenumber, l_suppkey,
       cast(l_linenumber % 3 as string) as class_id,
       (l_orderkey*7919 % 10007)/10007e0 as xc,
       ((l_orderkey*31 + l_linenumber*977) % 9973)/9973e0 as yc,
       l_quantity/1e3 as bw, (1 + l_suppkey % 40)/1e3 as bh
from lineitem""",
    "footprints": """select concat('IMG_', cast(o_orderkey as string)) as image_name, o_orderkey,
       (o_orderkey*7919 % 20011)/1e2 as x0, (o_orderkey*104729 % 100019)/1e2 as y0,
       (3 + o_custkey % 5)*(case when o_orderkey % 1009 = 0 then 10 else 1 end)/1e0 as fw,
       (3 + o_orderkey % 4)*(case when o_orderkey % 1009 = 0 then 10 else 1 end)/1e0 as fh,
       case when year(o_orderdate) % 2 = 0 then '2024' else '2023' end as campaign
from orders""",
    "cameras": """select event_id,
       case when user_id % 5 = 0 then '2024' when user_id % 5 = 1 then '2023' when event_id % 3 = 0 then '2024' else '2023' end as campaign,
       case when user_id % 5 = 0 then 2 when user_id % 5 = 1 then 1 when event_id % 3 = 0 then 2 else 1 end as campaign_ord,
       case when event_id % 2 = 0 then concat(' img_', cast(user_id as string), ' ')
            else concat('IMG_', cast(user_id as string)) end as label,
       (event_id*7919 % 8192)/1e0 as px, (event_id*104729 % 5460)/1e0 as py,
       (event_id % 997)/1e0 as cam_x, (event_id % 991)/1e0 as cam_y, 200e0 + value as cam_z
from events""",
    "slices": """select concat('IMG_', cast(c_custkey % 200 as string), '_', cast(c_custkey as string)) as tile,
       concat('IMG_', cast(c_custkey % 200 as string)) as parent_image,
       cast(c_custkey*37 % 3000 as int) as x_start, cast(c_custkey*53 % 2000 as int) as y_start
from customer""",
    "bg_candidates": """select concat('BG_', cast(o_orderkey as string)) as image_name, o_orderkey,
       (o_orderkey*7919 % 20011)/1e2 + 1.5e0 as x0, (o_orderkey*104729 % 100019)/1e2 + 0.5e0 as y0,
       3e0 as fw, 3e0 as fh, case when year(o_orderdate) % 2 = 0 then '2024' else '2023' end as campaign
from orders where o_orderkey % 4 = 1""",
    "disk": """select concat('IMG_', cast(o_orderkey as string)) as stem, o_orderkey % 17 <> 0 as has_image,
       o_orderkey % 13 <> 0 as has_label, o_orderkey % 19 = 0 as in_missing_log, o_orderkey % 23 = 0 as in_dropped_log
from orders""",
}


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    source = SOURCE[name]
    return spark.sql(SQL[name].replace(f"from {source}", "from {source}"), source=table(spark, sf_dir, source))


def with_views(names: list[str], ctes: dict[str, str], select: str) -> str:
    """DuckDB SQL: the views, further named queries, and the select."""
    parts = [f"{n} as ({SQL[n]})" for n in names] + [f"{n} as ({q})" for n, q in ctes.items()]
    return "with " + ",\n".join(parts) + "\n" + select
