"""Independent SQL (DuckDB dialect) for each registered check, over the raw test tables."""

from __future__ import annotations

from tablesmith.functions.tokens import NA_TOKENS
from tablesmith.registry.spark import DELETE_CRITERIA, UPDATE_CRITERIA


def _lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


NA_LIST = "(" + ", ".join(_lit(t) for t in NA_TOKENS) + ")"
NA_ARRAY = "[" + ", ".join(_lit(t) for t in NA_TOKENS) + "]"
TYPES_ARRAY = "['STRING', 'NUMBER', 'DATE', 'BOOLEAN', 'OTHER']"

ORDERS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
LINEITEM = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount",
            "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]
CUSTOMER = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]


_ODD = ("case when {k} % 17 = 0 then '12D' when {k} % 19 = 0 then '0x1p3' when {k} % 23 = 0 then ' NaN' "
        "when {k} % 29 = 0 then '5f' when {k} % 31 = 0 then ' ' || {c} || ' ' else {c} end")
_ODD_VALUE = ("case when {k} % 17 = 0 or {k} % 19 = 0 or {k} % 23 = 0 or {k} % 29 = 0 then null "
              "else cast(replace({c}, ',', '') as double) end")
_ODD_BAD = "({k} % 17 = 0 or {k} % 19 = 0 or ({k} % 23 <> 0 and {k} % 29 = 0))"


def _hash(cols: list[str]) -> str:
    return "sha256(" + " || ".join(f"coalesce(cast({c} as varchar), 'nan')" for c in cols) + ")"


def _na(cols: list[str]) -> str:
    return ", ".join(f"case when {c} in {NA_LIST} then null else {c} end as {c}" for c in cols)


_EXPORT_ROW = ("cast(orders.o_orderkey as varchar) as o_orderkey, cast(orders.o_custkey as varchar) as o_custkey, "
               "orders.o_orderstatus as o_orderstatus, format('{:,.2f}', orders.o_totalprice) as o_totalprice, "
               "cast(orders.o_orderdate as varchar) as o_orderdate, "
               "case when orders.o_orderkey % 7 = 0 then 'NA' else orders.o_orderpriority end as o_orderpriority")
EXPORT = (f"export as (select {_EXPORT_ROW} from orders "
          f"union all select {_EXPORT_ROW} from orders where orders.o_orderkey % 10 = 0)")
CLEAN = f"clean as (select {_na(ORDERS)} from export)"

SYNC = (f"with {EXPORT}, {CLEAN} select distinct {_hash(ORDERS)} as id, o_orderkey as order_no, "
        "cast(replace(o_totalprice, ',', '') as double) as amount, o_orderdate as order_date, "
        "o_orderpriority as priority, o_orderstatus as status from clean")

_MAP_ENTRY = ("{'source_key': n_name, 'destination_key': lower(replace(n_name, ' ', '_')), "
              f"'data_type': {TYPES_ARRAY}[n_regionkey % 5 + 1], "
              "'comment': 'column ' || cast(n_nationkey as varchar)}")

_JOBS = ("jobs as (select n_nationkey, cast(n_nationkey as varchar) as job_id, "
         "'cust_nation_' || cast(n_nationkey as varchar) as target_table, "
         "case n_nationkey % 3 when 0 then 'PENDING' when 1 then 'PASS' else 'FAILED' end as status, "
         "cast(null as varchar) as message from nation)")
_CUST_COUNTS = ("counts as (select c_nationkey, count(*) as n, round(sum(c_acctbal), 2) as balance, min(c_name) as first_name "
                "from customer group by c_nationkey)")


def _job_run(state: str) -> str:
    return (f"with {_JOBS}, {_CUST_COUNTS} select job_id, target_table, "
            f"case when status = '{state}' then 'PASS' else status end as status, "
            f"case when status = '{state}' then 'PASS' else message end as message, "
            f"case when status = '{state}' then coalesce(counts.n, 0) end as rows_loaded, "
            f"case when status = '{state}' then coalesce(counts.n, 0) end as n_rows, "
            f"case when status = '{state}' then counts.balance end as balance, "
            f"case when status = '{state}' then counts.first_name end as first_name, "
            f"case when status = '{state}' then coalesce(counts.n, 0) end as n_ids "
            "from jobs left join counts on jobs.n_nationkey = counts.c_nationkey")


def _profile(cols: list[str], tbl: str) -> str:
    parts = [f"select '{c}' as col_name, count(*) as n_rows, count({c}) as n_non_null, "
             f"count(distinct {c}) as n_distinct, cast(min({c}) as varchar) as min_value, "
             f"cast(max({c}) as varchar) as max_value from {tbl}" for c in cols]
    return " union all ".join(parts)


_PARTIAL_BATCH = ("b as (select o_orderkey, o_totalprice * 2 as o_totalprice from orders where o_orderkey % 10 = 0 "
                  "union all select o_orderkey + 1000000, o_totalprice from orders where o_orderkey % 100 = 0)")
_FULL_BATCH = ("b as (select o_orderkey, o_custkey, o_orderstatus, o_totalprice * 2 as o_totalprice, o_orderdate, "
               "'0-CHANGED' as o_orderpriority from orders where o_orderkey % 10 = 0 "
               "union all select o_orderkey + 1000000, o_custkey, o_orderstatus, o_totalprice, o_orderdate, "
               "o_orderpriority from orders where o_orderkey % 100 = 0)")

_CHILD = ("select * replace (case when c_custkey % 7 = 0 then c_nationkey + 100 else c_nationkey end as c_nationkey) "
          "from customer")

ORACLE: dict[str, str] = {
    "row_id": (f"with li as (select * replace (nullif(l_returnflag, 'R') as l_returnflag) from lineitem) "
               f"select l_orderkey, l_linenumber, l_linestatus as source_id, {_hash(LINEITEM)} as id from li"),
    "clean_numbers": (f"with t as (select o_orderkey as k, format('{{:,.2f}}', o_totalprice) as c from orders) "
                      f"select k as o_orderkey, {_ODD.format(k='k', c='c')} as amount_text, "
                      f"{_ODD_VALUE.format(k='k', c='c')} as amount, {_ODD_BAD.format(k='k')} as bad from t"),
    "sync_source_id": (f"with {EXPORT}, odd as (select * replace ({_ODD.format(k='cast(o_orderkey as bigint)', c='o_totalprice')} "
                       f"as o_totalprice), cast(o_orderkey as bigint) as k, o_totalprice as plain from export), "
                       f"clean as (select {_na(ORDERS)}, k, plain from odd) "
                       f"select distinct {_hash(ORDERS)} as id, o_custkey as customer, o_orderkey as order_no, "
                       f"{_ODD_VALUE.format(k='k', c='plain')} as amount from clean"),
    "dedup": (f"select distinct {_hash(ORDERS)} as id, o_orderkey, o_totalprice "
              "from (select * from orders union all select * from orders)"),
    "first_wins": ("select id, pos, o_orderkey, o_custkey, o_totalprice from (select *, row_number() over "
                   "(partition by id order by pos nulls last, o_orderkey) as rn from (select "
                   "sha256(coalesce(o_orderstatus, 'nan') || coalesce(o_orderpriority, 'nan')) as id, "
                   "case when o_orderkey % 5 <> 1 then o_orderkey end as pos, "
                   "o_orderkey, o_custkey, o_totalprice from orders)) where rn = 1"),
    "null_normalise": (f"with d as (select o_orderkey, case when o_orderkey % 40 < {len(NA_TOKENS)} "
                       f"then {NA_ARRAY}[o_orderkey % 40 + 1] else o_orderpriority end as o_orderpriority, "
                       "case when o_orderkey % 11 = 0 then 'NaN'::double else o_totalprice end as o_totalprice "
                       "from orders) select o_orderkey, "
                       f"case when o_orderpriority in {NA_LIST} then null else o_orderpriority end as o_orderpriority, "
                       "case when isnan(o_totalprice) then null else o_totalprice end as o_totalprice from d"),
    "type_map": ("select cast(o_orderkey as varchar) as o_orderkey, "
                 "cast(replace(format('{:,.2f}', o_totalprice), ',', '') as double) as o_totalprice, "
                 "case when o_orderstatus = 'F' then 'true' when o_orderstatus = 'O' then 'false' else 'yes' end "
                 "as is_final, cast(o_orderdate as varchar) as o_orderdate from orders"),
    "map_columns": (f"select {_hash(ORDERS)} as id, cast(o_orderkey as varchar) as order_no, "
                    "o_totalprice as amount, cast(o_orderdate as varchar) as order_date, "
                    "o_orderpriority as priority, o_orderstatus as status from orders"),
    "sync_table": SYNC,
    "full_refresh": SYNC,
    "load_history": (f"with s as ({SYNC}) select 'full_refresh' as mode, count(*) as rows_written, true as is_first from s "
                     "union all select 'append', count(s.id), false from range(12) k(i) left join s "
                     "on cast(s.order_no as bigint) % 12 = k.i group by k.i "
                     "union all select 'insert_ignore', 0, false"),
    "landing_sync": SYNC,
    "csv_export": ("select " + ", ".join(f"cast({c} as varchar) as {c}" for c in ORDERS) + " from orders"),
    "csv_scan": (f"with {EXPORT}, dirty as (select o_orderkey, o_custkey, o_orderstatus, o_totalprice, "
                 "o_orderdate, case when cast(o_orderkey as bigint) % 13 = 0 "
                 "then 'say \"hi\", ' || chr(10) || 'then bye' else o_orderpriority end as o_orderpriority "
                 f"from export) select {_na(ORDERS)} from dirty"),
    "view_export": ("select o_custkey, count(*) as n_orders, max(o_totalprice) as max_price "
                    "from orders group by o_custkey"),
    "select_all": ("select o_orderkey, c_name, o_totalprice * 2 as doubled from orders join customer "
                   "on o_custkey = c_custkey"),
    "inline_rows": ("select c_custkey, n_name as nation, r_name as region from customer "
                    "left join nation on c_nationkey = n_nationkey left join region on n_regionkey = r_regionkey"),
    "text_rows": "select * replace (lower(c_name) as c_name) from customer",
    "add_row": ("select * from orders union all select 1000000001, 1, 'O', 10.5, "
                "TIMESTAMP '2024-01-02 00:00:00', '1-URGENT' "
                "union all select 1000000002, null, null, null, null, null"),
    "mapping_scan": ("select n_name as source_key, lower(replace(n_name, ' ', '_')) as destination_key, "
                     f"{TYPES_ARRAY}[n_regionkey % 5 + 1] as data_type "
                     "from nation join region on n_regionkey = r_regionkey"),
    "mapping_collect": ("select 'tbl_' || lower(r_name) as target_table, count(*) as n_columns, "
                        f"cast(to_json(list({_MAP_ENTRY} order by n_nationkey)) as varchar) as column_mapping_json "
                        "from nation join region on n_regionkey = r_regionkey group by r_name"),
    "mapping_json": ("select cast(to_json({'view_id': cast(r_regionkey as varchar), 'source_table': r_name, "
                     "'target_table': 'tbl_' || lower(r_name), "
                     f"'column_mapping': list({_MAP_ENTRY} order by n_nationkey)}}) as varchar) as document "
                     "from nation join region on n_regionkey = r_regionkey group by r_regionkey, r_name"),
    "sql_source": ("select o_orderstatus, count(*) as n_orders, round(sum(o_totalprice), 2) as total "
                   "from orders group by o_orderstatus"),
    "param_query": ("select o_orderkey, o_totalprice from orders "
                    "where o_totalprice > 200000.0 and o_orderstatus = 'F'"),
    "import_new_table": ("select o_orderkey, o_custkey, o_orderstatus, case when o_orderkey % 11 <> 0 then o_totalprice end "
                         "as o_totalprice, o_orderdate, case when o_orderkey % 7 <> 0 then o_orderpriority end "
                         "as o_orderpriority from orders"),
    "import_append": ("select * replace (case when o_orderkey % 2 = 1 then o_totalprice + 1 else o_totalprice end "
                      "as o_totalprice) from orders where o_orderkey % 2 in (0, 1) union all "
                      "select o_orderkey, o_custkey, null, null, null, null from orders where o_orderkey % 10 = 1"),
    "save_as": ("select *, 'copy' as of from orders union all select *, 'source' from orders where o_orderstatus = 'F'"),
    "create_table": ("select cast(null as varchar) as o_note, o_custkey, o_orderkey, "
                     "cast(cast(o_totalprice as decimal(18,2)) as double) as o_totalprice, 0 as rows_at_first from orders"),
    "import_truncateadd": "select * from orders where o_orderstatus = 'F'",
    "import_updateadd": (f"with {_PARTIAL_BATCH} select coalesce(o.o_orderkey, b.o_orderkey) as o_orderkey, "
                         "o.o_custkey, o.o_orderstatus, "
                         "case when b.o_orderkey is not null then b.o_totalprice else o.o_totalprice end "
                         "as o_totalprice, o.o_orderdate, o.o_orderpriority "
                         "from orders o full outer join b on o.o_orderkey = b.o_orderkey"),
    "upsert": (f"with {_FULL_BATCH} select * from orders where o_orderkey not in (select o_orderkey from b) "
               "union all select * from b"),
    "insert_ignore": ("select * from orders where o_orderkey % 2 = 0 union all "
                      "select o_orderkey, o_custkey, o_orderstatus, o_totalprice + 1 as o_totalprice, o_orderdate, "
                      "o_orderpriority from orders where o_orderkey % 2 = 1"),
    "update_where": (f"select o_orderkey, case when coalesce({UPDATE_CRITERIA}, false) then 0 else o_custkey end "
                     "as o_custkey, o_orderstatus, o_totalprice, o_orderdate, "
                     f"case when coalesce({UPDATE_CRITERIA}, false) then '0-CRITICAL' else o_orderpriority end "
                     "as o_orderpriority from orders"),
    "delete_where": f"select * from orders where not coalesce({DELETE_CRITERIA}, false)",
    "add_column": "select *, cast(null as varchar) as p_note from part",
    "rename_column": "select p_partkey, p_name as p_title, p_brand, p_type, p_size, p_retailprice from part",
    "delete_column": "select p_partkey, p_name, p_brand, p_size, p_retailprice from part",
    "hide_columns": "select p_partkey, p_name, p_size, p_retailprice from part",
    "show_columns": "select p_partkey, p_name, p_type, p_retailprice from part",
    "apply_formulas": ("select l_orderkey, l_linenumber, l_extendedprice * (1 - l_discount) as revenue, "
                       "l_extendedprice * (1 - l_discount) * (1 + l_tax) as charge from lineitem"),
    "lookup": (f"with c as ({_CHILD}) select c.*, n.n_name, n.n_regionkey from c left join nation n "
               "on c.c_nationkey = n.n_nationkey"),
    "remove_lookup": (f"with c as ({_CHILD}) select c.*, n.n_name from c left join nation n "
                      "on c.c_nationkey = n.n_nationkey"),
    "profile_table": _profile(CUSTOMER, "customer"),
    "profile_column": "select cast(event_type as varchar) as value, count(*) as n from events group by event_type",
    "similar_report": ("select o_orderstatus as group_key, count(*) as n, round(sum(o_totalprice), 2) as total, "
                       "min(o_totalprice) as lo, max(o_totalprice) as hi from orders "
                       "where o_totalprice > 50000 and o_orderstatus <> 'P' group by o_orderstatus"),
    "load_audit": (f"with {EXPORT}, odd as (select * replace ({_ODD.format(k='cast(o_orderkey as bigint)', c='o_totalprice')} "
                   f"as o_totalprice), {_ODD_BAD.format(k='cast(o_orderkey as bigint)')} as bad from export), "
                   f"clean as (select {_na(ORDERS)}, bad from odd), ided as (select *, {_hash(ORDERS)} as id from clean) "
                   "select count(*) as rows_read, count(distinct id) as rows_loaded, "
                   "count(*) - count(distinct id) as duplicate_rows, "
                   "count(*) filter (where o_orderpriority is null) as nulls_o_orderpriority, "
                   "count(*) filter (where bad) as bad_o_totalprice from ided"),
    "due_jobs": ("select cast(n_nationkey as varchar) as job_id, "
                 "'cust_nation_' || cast(n_nationkey as varchar) as target_table, 'PENDING' as status "
                 "from nation where n_nationkey % 3 = 0"),
    "update_job_state": ("select cast(n_nationkey as varchar) as job_id, case when n_nationkey = 7 then 'FAILED' "
                         "else case n_nationkey % 3 when 0 then 'PENDING' when 1 then 'PASS' else 'FAILED' end end "
                         "as status, case when n_nationkey = 7 then 'export failed' end as message, "
                         "case when n_nationkey = 7 then 1700000000000 else 0 end as updated_at from nation"),
    "failure_alerts": ("select cast(n_nationkey as varchar) as job_id, 'Table sync failed ' || "
                       "strftime(epoch_ms(1700000000000 + n_nationkey * 60000) + interval '5 hours 30 minutes', "
                       "'%d-%m-%Y %H:%M:%S') as subject, 'Sync of customer into cust_nation_' || n_nationkey || "
                       "' ended FAILED: ' || case when n_nationkey % 4 = 0 then 'export failed' || chr(10) || 'at line 2' "
                       "else 'no message' end as description from nation where n_nationkey % 3 = 0 and n_nationkey % 2 = 0"),
    "sync_jobs": _job_run("PENDING"),
    "refetch": _job_run("FAILED"),
    "ist_text": ("select event_id, strftime(ts + interval '5 hours 30 minutes', '%d-%m-%Y %H:%M:%S') as ist_text, "
                 "strftime(ts + interval '5 hours 30 minutes', '%d-%m-%Y %H:%M:%S') as ist_text_of_instant from events"),
    "epoch_ms": ("select event_id, cast(floor(epoch(ts)) as bigint) * 1000 as epoch_ms, "
                 "cast(floor(epoch(ts)) as bigint) * 1000 as epoch_ms_of_instant from events"),
}

# -- changes of stored tables, shared scans, files in blocks -----------------------------------------
_LATER = ("(select o_orderkey, o_custkey, case when o_orderkey % 10 = 3 then 'X' else o_orderstatus end as o_orderstatus, o_totalprice, "
          "o_orderdate, o_orderpriority from orders where o_orderkey % 11 <> 0) as orders")
_SYNC_LATER = SYNC.replace("from orders", f"from {_LATER}")
_PART = "cast(null as varchar) as p_name, p_brand, cast(null as double) as p_type"

ORACLE |= {
    "sync_jobs_shared": (
        f"with {_CUST_COUNTS} select cast(n_nationkey as varchar) as job_id, 'cust_nation_' || n_nationkey as target_table, "
        "case when n_nationkey = 7 then 'FAILED' else 'PASS' end as status, case when n_nationkey = 7 then 'true' else 'PASS' end as message, "
        "case when n_nationkey <> 7 then coalesce(n, 0) end as rows_loaded, case when n_nationkey <> 7 then coalesce(n, 0) end as n_rows, "
        "case when n_nationkey <> 7 then balance end as balance, case when n_nationkey <> 7 then first_name end as first_name, "
        "case when n_nationkey <> 7 then coalesce(n, 0) end as n_ids from nation left join counts on c_nationkey = n_nationkey"),
    "update_where_stored": (f"select *, (select count(*) from orders where {UPDATE_CRITERIA}) as n_updated from ({ORACLE['update_where']})"),
    "delete_where_stored": ("select *, (select count(*) from orders where o_orderkey % 3 = 1 and o_orderstatus = 'F') as n_deleted from orders "
                            "where not (o_orderkey % 3 = 1 and o_orderstatus = 'F')"),
    "add_row_stored": ("select *, 2 as n_added from (select * from orders union all select 1000000001, null, null, null, "
                       "TIMESTAMP '2024-01-02 00:00:00', null union all select 1000000002, null, null, 1.5, null, null)"),
    "columns_stored": (f"select p_partkey, p_name as p_title, p_retailprice, {_PART} from part union all by name "
                       "select p_partkey + 1000000 as p_partkey, cast(null as varchar) as p_title, cast(null as double) as p_retailprice, "
                       "upper(p_name) as p_name, p_brand, cast(p_size as double) as p_type from part where p_partkey % 10 = 0"),
    "refresh_difference": (f"with a as ({SYNC}), b as ({_SYNC_LATER}) select *, (select count(*) from b where id not in (select id from a)) as n_added, "
                           "(select count(*) from a where id not in (select id from b)) as n_removed, 0 as n_written_again from b"),
    "load_details": ("select which, true as by_id, 'append' as mode, status, says_why, (select count(*) from orders where o_orderstatus = 'F') as n_rows "
                     "from (values ('good', 'COMPLETED', false), ('wrong', 'FAILED', true)) as v(which, status, says_why)"),
    "save_as_shared": ("select *, 'source' as of from orders where o_orderkey % 3 <> 1 union all by name "
                       "select * replace (case when o_orderkey % 3 = 2 then 'C' else o_orderstatus end as o_orderstatus), 'copy' as of from orders"),
    "csv_scan_split": ORACLE["csv_scan"],
    "profile_sketches": " union all ".join(
        f"select '{c}' as col_name, (select count(*) from lineitem) as n_rows, (select count({c}) from lineitem) as n_non_null, "
        "true as distinct_ok, true as ranks_ok, true as counts_ok, coalesce((select string_agg(v, ',' order by v) from ("
        f"select cast({c} as varchar) as v, count(*) as n from lineitem where {c} is not null group by {c}) "
        f"where n > 7.0 / 4096 * (select count({c}) from lineitem)), '') as common"
        for c in ("l_partkey", "l_quantity", "l_discount", "l_returnflag", "l_linestatus")),
    "profile_default": f"select * exclude (n_distinct), true as distinct_ok from ({_profile(['l_partkey', 'l_quantity', 'l_shipdate', 'l_returnflag'], 'lineitem')})",
    "auto_identify": ORACLE["csv_scan"],
    "first_wins_file": "select cast(o_custkey as varchar) as o_custkey, cast(max(o_orderkey) as varchar) as o_orderkey from orders group by o_custkey",
}
