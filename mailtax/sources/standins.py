"""The logical tables derived from a general order / line item data set.

This maps the order tables onto the billing model so that every job runs over whole, large tables: an order is
an invoice, a customer's year a session, a line item a mail piece, a supplier's nation an address. Orders of
status F and O are billed from host 1 and host 2 and have no transactions yet; status P is native data.

Some rows stand for what is rare in orders: every fifth order's last category is shared by its first line; every seventh
order's lines also have an activity of a category without details; returned categories carry a second rate, with price 0
where the first has none; some details have no piece id or one that neither host knows; the first pieces of host 1 are
known to host 2, too; the lines of every third order sell another vendor item than the catalogue names; spellings vary.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cache, partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from mailtax import schemas
from mailtax.functions import rules
from mailtax.functions.expressions import packed_fields, unpacked_fields
from mailtax.functions.staging import cut, cut_in_buckets
from mailtax.sources.tables import LazyTables

# Number of the catalogue item = p_size % 13: the modules in this order, an unknown one, a service.
MODULES = [
    *(f"Billing.Calculators.{name}" for name in (
        rules.ADDITIONAL_PAGES, rules.DUPLEX, rules.INSERTS, rules.LETTER_SHOP,
        rules.ADDITIONAL_POSTAGE_INTERNATIONAL, rules.ADDITIONAL_POSTAGE, rules.FORCE_MAIL_POSTAGE,
        rules.FORCE_MAIL_SPECIAL_HANDLING, rules.INTERNATIONAL_POSTAGE_CANADA, rules.INTERNATIONAL_POSTAGE,
        rules.POSTAGE,
    )),
    "Billing.Calculators.Archive.ScanLineItemCalculator",
    "Billing.Calculators.Service.ReturnsLineItemCalculator",
]
SERVICE_ITEM = len(MODULES) - 1
STORED_BY = {"invoice_line_items": "invoice_key"}  # lies by order as it is derived
# One row of a stored table or a file for each of theirs, at most with the place of its supplier.
SPELLED = {
    "details", "return_details", "invoices", "activity_batches", "customers", "host_client_configs", "file_stream_configs",
    "host1_pieces", "host2_pieces", "delivery_points",
}


# Bits of a line item's small values as they are shuffled; a row with one that is NULL or larger is shuffled as it is.
LINE_BITS = {"l_suppkey": 26, "l_linenumber": 4, "l_quantity": 7, "l_returnflag": 5, "l_linestatus": 5, "discounted": 1, "l_shipdate": 15}


def packed_lines(rows: DataFrame) -> DataFrame:
    """Line items with their small values as one number ``small``, or in ``whole`` as they are where that number cannot hold them."""

    def letter(name: str) -> Column:
        return F.when(F.col(name).rlike("^[A-Z]$") & (F.length(name) == 1), F.ascii(name) - 65)

    quantity = F.when(F.col("l_quantity").between(0, 127), F.col("l_quantity").cast("bigint"))
    numbers = {
        "l_quantity": F.when(quantity == F.col("l_quantity"), quantity),
        "l_returnflag": letter("l_returnflag"),
        "l_linestatus": letter("l_linestatus"),
        "discounted": F.col("discounted").cast("int"),
        "l_shipdate": F.unix_date("l_shipdate"),
    }
    small = packed_fields([(numbers.get(name, F.col(name)), bits) for name, bits in LINE_BITS.items()])
    whole = F.when(F.col("small").isNull(), F.struct(*LINE_BITS))
    return rows.withColumn("small", small).withColumn("whole", whole).drop(*LINE_BITS)


def unpacked_lines(lines: DataFrame, schema: StructType) -> DataFrame:
    """Rows of ``packed_lines`` as they were, with what was joined to them."""
    numbers = dict(zip(LINE_BITS, unpacked_fields(F.col("small"), list(LINE_BITS.values())), strict=True))
    for name in ("l_returnflag", "l_linestatus"):
        numbers[name] = F.char(numbers[name] + 65)
    numbers["l_shipdate"] = F.date_from_unix_date(numbers["l_shipdate"].cast("int"))
    values = {
        name: F.when(F.col("small").isNull(), F.col("whole")[name]).otherwise(numbers[name].cast(schema[name].dataType))
        for name in LINE_BITS
    }
    return lines.withColumns(values).drop("small", "whole")


_staged: dict[tuple[str, str, str], DataFrame] = {}


def standin_tables(spark: SparkSession, sf_dir: str) -> LazyTables:
    """The tables over one data folder. Joins and groupings are done and written once per application, on first use.

    The jobs then scan stored tables, as they would in a billing database, and do not repeat the derivation. Tables that only
    rename or spell columns of a stored one (``SPELLED``) are read from that, not written once more.
    """

    def stage(name: str, build: Callable[[], DataFrame], store: Callable[[DataFrame], DataFrame] = cut) -> DataFrame:
        key = (spark.sparkContext.applicationId, sf_dir, name)
        if key not in _staged:
            _staged[key] = store(build())
        return _staged[key]

    def table(name: str, build: Callable[[], DataFrame]) -> Callable[[], DataFrame]:
        if name in SPELLED:
            return build
        key = STORED_BY.get(name)
        return partial(stage, name, build, cut if key is None else lambda df: cut_in_buckets(df, key)[0])

    return LazyTables({n: table(n, b) for n, b in _builders(spark, sf_dir, stage).items()})


def _builders(spark: SparkSession, sf_dir: str, stage: Callable[[str, Callable[[], DataFrame]], DataFrame]):
    @cache
    def raw(name: str) -> DataFrame:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")

    def cents_to_money(cents: Column) -> Column:
        return (cents.cast("decimal(19,4)") / 100).cast("decimal(19,4)")

    def shaped(df: DataFrame, table: str, **values: Column) -> DataFrame:
        return df.select(
            *[values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in schemas.schema(table)]
        )

    def orders() -> DataFrame:
        year = F.year("o_orderdate")
        return raw("orders").select(
            F.col("o_orderkey").alias("l_orderkey"),
            "o_custkey",
            "o_orderstatus",
            F.col("o_orderdate").cast("timestamp_ntz").alias("o_orderdate"),
            F.substring("o_orderpriority", 1, 1).cast("int").alias("priority"),
            F.round(F.col("o_totalprice") * 100).cast("bigint").alias("cents"),
            (F.col("o_custkey") * 10000 + year).cast("bigint").alias("session_key"),
        )

    def joined_pieces() -> DataFrame:
        items = raw("part").select(F.col("p_partkey").alias("l_partkey"), (F.col("p_size") % 13).alias("item"))
        rows = raw("lineitem").select(
            "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_returnflag", "l_linestatus",
            (F.col("l_discount") >= 0.05).alias("discounted"),  # as little of each row as the tables tell apart is shuffled
            F.col("l_shipdate").cast("date").alias("l_shipdate"),
        )
        parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
        lines = packed_lines(rows).join(items, "l_partkey").repartition(parts, "l_orderkey")
        return unpacked_lines(lines, rows.schema).join(orders().drop("session_key"), "l_orderkey")

    def pieces() -> DataFrame:
        """Line items with catalogue item, order and keys: one row per mail piece, joined and stored once, by order.

        The keys are spelled from the stored columns, as an id of 32 digits takes more room than all these.
        """
        day = F.col("l_shipdate")
        common = day.between(F.lit("0001-01-01").cast("date"), F.lit("9999-12-31").cast("date"))  # written alike, and faster, by a cast
        day = F.when(common, day.cast("string")).otherwise(F.date_format(day, "yyyy-MM-dd"))
        line = (F.col("l_orderkey") * 100 + F.col("item")).cast("bigint")
        flag = F.when(F.col("l_returnflag") == "A", 1).when(F.col("l_returnflag") == "N", 2).otherwise(3)
        return (
            stage("joined pieces", joined_pieces, lambda df: cut_in_buckets(df, "l_orderkey")[0])
            .withColumn("piece_id", F.md5(F.concat_ws("|", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", day)))
            .withColumn("line", line)
            .withColumn("flag_key", flag)
            .withColumn("category", (line * 10 + flag).cast("bigint"))
            .drop("l_partkey", "l_shipdate")
        )

    def addresses() -> DataFrame:
        return (
            raw("nation")
            .join(raw("region"), F.col("n_regionkey") == F.col("r_regionkey"))
            .select("n_nationkey", "n_name", "n_regionkey", "r_name",
                    F.lpad(F.col("n_nationkey").cast("string"), 5, "0").alias("postal"))
        )

    def suppliers() -> DataFrame:
        """Where each supplier is."""
        kind = F.col("n_nationkey") % 10
        hidden = lambda c: F.when(kind == 0, F.lit(None)).when(kind == 5, F.lit("")).otherwise(c)
        places = addresses().select(
            F.col("n_nationkey").alias("s_nationkey"),
            "n_name",
            "n_regionkey",
            hidden(F.col("n_name")).alias("city"),
            hidden(F.col("r_name")).alias("state"),
            hidden(F.col("postal")).alias("zip"),
        )
        return raw("supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey").join(places, "s_nationkey")

    def mailed(status: str) -> DataFrame:
        """Pieces of orders with this status and the address they were mailed to."""
        return pieces().where(F.col("o_orderstatus") == status).join(stage("suppliers", suppliers), "l_suppkey")

    def native_guid() -> Column:
        return F.md5(F.concat_ws("-", F.lit("bt"), "category", "l_linenumber"))

    def catalogue(table: str, **values: Column) -> DataFrame:
        items = raw("part").select((F.col("p_size") % 13).alias("item")).distinct()
        return shaped(items, table, **values)

    def from_lines(table: str, **values: Column) -> DataFrame:
        pages = F.col("l_quantity").cast("bigint")
        sheets = F.floor((pages + 1) / 2)
        host2 = F.col("o_orderstatus") == "O"
        sums = (
            pieces()
            .groupBy("l_orderkey", "item", "line", "o_orderstatus", "priority", "cents")
            .agg(
                F.count("*").alias("pieces"),
                F.sum(sheets - 1).alias("extra_sheets"),
                F.sum(pages - sheets).alias("duplex_sides"),
            )
        )
        quantity = (
            F.when(host2 & (F.col("item") == 0), F.col("extra_sheets"))
            .when(host2 & (F.col("item") == 1), F.col("duplex_sides"))
            .otherwise(F.col("pieces"))
        )
        return shaped(sums.withColumn("billed", quantity), table, **values)

    item = F.col("item")
    item_key = (item + 1).cast("bigint")
    modules = F.array(*[F.lit(m) for m in MODULES])

    def line_items() -> DataFrame:
        return catalogue(
            "line_items",
            line_item_key=item_key,
            line_item_name=F.concat(F.lit("Item "), item),
            line_item_description=F.concat(F.lit("Catalogue item "), item),
            module=modules[item],
            sales_tax_code_key=item % 5 + 1,
            tax_category=F.when(item == SERVICE_ITEM, "Service").when(item >= 4, "Postage").otherwise("Print"),
            use_customer_tax_address=item == SERVICE_ITEM,
            is_exportable=item % 4 != 3,
            vendor_item_key=item_key,
        )

    def invoice_line_items() -> DataFrame:
        return from_lines(
            "invoice_line_items",
            invoice_line_item_key=F.col("line"),
            invoice_key=F.col("l_orderkey"),
            line_item_key=item_key,
            vendor_item_key=F.when(F.col("l_orderkey") % 3 == 0, (item + 1) % len(MODULES)).otherwise(item) + 1,
            group_key=F.concat(F.lit("group-"), item % 4),
            quantity=F.col("billed"),
            rate=F.when(F.col("priority") < 5, cents_to_money(F.floor(F.col("cents") / 1000))),
            extended_amount=cents_to_money(F.col("cents")),
        )

    def activities() -> DataFrame:
        own = pieces().select("l_orderkey", "o_custkey", "priority", "line", "category", "flag_key").distinct()
        order = ["l_orderkey", "o_custkey", "priority"]
        empty = own.where("l_orderkey % 7 = 0").withColumns({"category": -F.col("line"), "flag_key": F.lit(3)}).distinct()
        shared = (
            own.where("l_orderkey % 5 = 0")
            .groupBy(*order)
            .agg(F.min("line").alias("line"), F.max("category").alias("category"))
            .where("category div 10 <> line")
            .withColumn("flag_key", (F.col("category") % 10).cast("int"))
        )
        second = F.col("flag_key") == 3
        return shaped(
            own.unionByName(empty).unionByName(shared),
            "activities",
            invoice_line_item_key=F.col("line"),
            category_key=F.col("category"),
            client_line_item_key=F.col("line") % 100 + 101,
            rate_model_key=F.when(second, -1 - F.col("o_custkey")).otherwise(F.col("o_custkey")),
            rate_key=F.when(second, F.col("priority") % 5 + 1).otherwise(F.col("priority")),
            include_in_sales_tax_batch=F.col("flag_key") != 2,
        )

    def activity_categories() -> DataFrame:
        totals = (
            pieces()
            .groupBy("l_orderkey", "category", "flag_key")
            .agg(
                F.sum("l_quantity").cast("bigint").alias("quantity"),
                F.count_if("discounted").alias("suppressed"),
                F.count_if(F.col("l_linestatus") == "F").alias("updated"),
                F.count_if(F.col("l_linestatus") == "O").alias("returned"),
            )
        )
        return shaped(
            totals,
            "activity_categories",
            category_key=F.col("category"),
            activity_batch_key=F.col("l_orderkey"),
            category_type_key=F.col("flag_key"),
            batch_total=F.col("quantity"),
            total_suppressed=F.col("suppressed"),
            total_updated=F.col("updated"),
            total_returned=F.col("returned"),
        )

    def details() -> DataFrame:
        flag = F.col("l_returnflag")
        order = F.when(F.col("l_linenumber") == 2, F.col("l_orderkey") % 11)
        piece = (
            F.when(order == 0, F.lit(None))
            .when(order == 1, "00000000000000000000000000000000")
            .when(order == 2, "")
            .otherwise(F.col("piece_id"))
        )
        return shaped(
            pieces(),
            "details",
            detail_key=F.conv(F.substring("piece_id", 1, 15), 16, 10),
            detail_id=F.col("piece_id"),
            category_key=F.col("category"),
            transaction_guid=F.when(F.col("o_orderstatus") == "P", native_guid()),
            data_stream_detail_id=piece,
            return_detail_id=F.when(flag != "N", F.concat(F.lit("r"), F.col("piece_id"))),
        )

    force = F.col("discounted")

    def host1_pieces() -> DataFrame:
        odd = F.col("l_linenumber") % 2 == 1
        return shaped(
            mailed("F"),
            "host1_pieces",
            data_stream_detail_id=F.col("piece_id"),
            city=F.when(odd, F.lower("city")).otherwise(F.col("city")),
            state=F.col("state"),
            zip=F.col("zip"),
            country=F.when(F.col("s_nationkey") == 3, F.lit("CANADA")).otherwise(F.col("n_name")),
            is_foreign=F.when(F.col("n_regionkey") != 4, F.col("n_regionkey") != 0),
            is_force_mailed=force,
            is_active=F.col("l_linestatus") == "F",
        )

    def host2_pieces() -> DataFrame:
        pages = F.col("l_quantity").cast("int")
        return shaped(
            mailed("O").unionByName(mailed("F").where("l_linenumber = 1")),
            "host2_pieces",
            data_stream_detail_id=F.col("piece_id"),
            city=F.col("city"),
            state=F.lower("state"),
            zip=F.col("zip"),
            page_count=pages,
            paper_page_count=F.floor((pages + 1) / 2),
            is_force_mailed=force,
            is_foreign=F.when(F.col("n_regionkey") != 4, F.col("n_regionkey") != 0),
        )

    def delivery_points() -> DataFrame:
        region = F.col("n_regionkey")
        return shaped(
            mailed("P"),
            "delivery_points",
            delivery_point_id=F.col("piece_id"),
            transaction_guid=native_guid(),
            city=F.when(F.col("l_linenumber") % 2 == 1, F.initcap("city")).otherwise(F.col("city")),
            state_region=F.col("state"),
            postal_code=F.col("zip"),
            destination_code=F.when(region == 1, "F").when(region == 2, "N").otherwise("D"),
            quantity=F.col("l_quantity"),
            user_added=F.lit("native"),
            is_active=F.col("l_linestatus") == "F",
        )

    def transactions() -> DataFrame:
        rows = (
            pieces()
            .where(F.col("o_orderstatus") == "P")
            .groupBy("category", "l_linenumber", "o_custkey", "o_orderdate")
            .agg(F.sum("l_quantity").alias("quantity"))
        )
        return shaped(
            rows,
            "transactions",
            transaction_id=F.col("category") * 10 + F.col("l_linenumber"),
            transaction_guid=native_guid(),
            customer_id=F.col("o_custkey"),
            transaction_date=F.col("o_orderdate"),
            quantity=F.col("quantity"),
            user_added=F.lit("native"),
            date_added=F.col("o_orderdate"),
            is_active=F.lit(True),
        )

    def invoices() -> DataFrame:
        return shaped(
            orders(),
            "invoices",
            invoice_key=F.col("l_orderkey"),
            session_key=F.col("session_key"),
            client_configuration_key=F.col("o_custkey"),
            invoice_billing_date=F.col("o_orderdate"),
            date_added=F.col("o_orderdate"),
            user_added=F.concat(F.lit("clerk-"), F.col("priority")),
            is_active=F.col("o_orderstatus") != "P",
        )

    def sessions() -> DataFrame:
        return shaped(
            orders().select("session_key", "o_custkey").distinct(),
            "sessions",
            session_key=F.col("session_key"),
            session_id=F.md5(F.concat(F.lit("s-"), F.col("session_key"))),
            client_configuration_key=F.col("o_custkey"),
        )

    def config_id(key: str) -> Column:
        return F.md5(F.concat(F.lit("cc-"), F.col(key)))

    def stream_id(key: str) -> Column:
        return F.md5(F.concat(F.lit("fs-"), F.col(key)))

    def client_configurations() -> DataFrame:
        home = raw("customer").join(addresses(), F.col("c_nationkey") == F.col("n_nationkey"))
        return shaped(
            home,
            "client_configurations",
            client_configuration_key=F.col("c_custkey"),
            client_configuration_id=config_id("c_custkey"),
            client_key=F.col("c_nationkey"),
            client_configuration_name=F.col("c_name"),
            account_code=F.concat(F.lit("ACCT-"), F.col("c_custkey")),
            taxable_city=F.col("n_name"),
            taxable_state=F.col("r_name"),
            taxable_postal_code=F.col("postal"),
        )

    def customers() -> DataFrame:
        return shaped(
            raw("customer").where(F.col("c_acctbal") >= 0),
            "customers",
            customer_id=F.col("c_custkey"),
            account=F.concat(F.lit("ACCT-"), F.col("c_custkey")),
        )

    def rate_models() -> DataFrame:
        cents = F.round(F.col("c_acctbal") * 100).cast("bigint")
        price = F.when(F.col("c_acctbal") >= 0, cents_to_money(cents))
        customer = raw("customer").select("c_custkey", price.alias("price"))
        models = customer.union(customer.select(-1 - F.col("c_custkey"), F.coalesce("price", F.lit(0))))
        return shaped(models, "rate_models", rate_model_key=F.col("c_custkey"), price=F.col("price"))

    def rates() -> DataFrame:
        rate = F.col("priority")
        kind = F.when(rate == 1, 6).when(rate == 2, 8).when(rate != 3, 1)
        return shaped(orders().select("priority").distinct(), "rates", rate_key=rate, rate_type_key=kind)

    def transaction_types() -> DataFrame:
        guids = F.array(*[F.lit(g) for g in sorted(set(rules.TYPE_GUID.values()))[:-1]])
        guid = F.coalesce(F.get(guids, F.col("n_nationkey")), F.md5(F.concat(F.lit("type-"), F.col("n_nationkey"))))
        return shaped(
            raw("nation"),
            "transaction_types",
            transaction_type_id=F.col("n_nationkey") + 1,
            transaction_type_guid=F.when(F.col("n_nationkey") % 2 == 1, F.upper(guid)).otherwise(guid),
        )

    def statuses() -> DataFrame:
        first = F.col("r_regionkey") == 0
        other = F.md5(F.concat(F.lit("status-"), F.col("r_regionkey")))
        return shaped(
            raw("region"),
            "sales_tax_batch_statuses",
            status_key=F.col("r_regionkey") + 1,
            status_id=F.when(first, rules.NEW_BATCH_STATUS_ID.upper()).otherwise(other),
        )

    flag = F.col("l_returnflag")
    reason_id = F.md5(F.concat(F.lit("reason-"), flag))
    return {
        "sessions": sessions,
        "invoices": invoices,
        "invoice_line_items": invoice_line_items,
        "line_items": line_items,
        "sales_tax_codes": lambda: shaped(
            raw("region"),
            "sales_tax_codes",
            sales_tax_code_key=F.col("r_regionkey") + 1,
            tax_code=F.concat(F.lit("TC"), F.col("r_regionkey")),
        ),
        "sales_tax_batch_statuses": statuses,
        "vendor_items": lambda: catalogue(
            "vendor_items", vendor_item_key=item_key, vendor_item_name=F.concat(F.lit("Vendor item "), item)
        ),
        "clients": lambda: shaped(raw("nation"), "clients", client_key=F.col("n_nationkey")),
        "client_configurations": client_configurations,
        "customers": customers,
        "host_client_configs": lambda: shaped(
            raw("customer"), "host_client_configs", client_configuration_id=config_id("c_custkey")
        ),
        "file_stream_configs": lambda: shaped(
            raw("customer"),
            "file_stream_configs",
            client_configuration_id=config_id("c_custkey"),
            file_stream_config_id=stream_id("c_custkey"),
        ),
        "file_streams": lambda: shaped(
            raw("events"),
            "file_streams",
            file_stream_config_id=stream_id("user_id"),
            date_added=F.col("ts").cast("timestamp_ntz"),
            is_active=F.col("event_type") == "click",
        ),
        "activities": activities,
        "rate_models": rate_models,
        "rates": rates,
        "client_line_items": lambda: catalogue(
            "client_line_items", client_line_item_key=item + 101, line_item_key=item_key
        ),
        "activity_batches": lambda: shaped(
            orders(),
            "activity_batches",
            activity_batch_key=F.col("l_orderkey"),
            activity_batch_id=F.md5(F.concat(F.lit("bab-"), F.col("l_orderkey"))),
            user_added=F.concat(F.lit("loader-"), F.col("o_orderstatus")),
            is_native_batch=F.col("o_orderstatus") == "P",
        ),
        "activity_categories": activity_categories,
        "activity_category_types": lambda: shaped(
            raw("lineitem").select(flag).distinct(),
            "activity_category_types",
            category_type_key=F.when(flag == "A", 1).when(flag == "N", 2).otherwise(3),
            category_type_id=F.md5(F.concat(F.lit("ct-"), flag)),
            category_type_name=F.concat(F.lit("Category "), flag),
        ),
        "details": details,
        "host1_pieces": host1_pieces,
        "host2_pieces": host2_pieces,
        "return_details": lambda: shaped(
            pieces().where(flag != "N"),
            "return_details",
            return_detail_id=F.concat(F.lit("r"), F.col("piece_id")),
            return_reason_id=reason_id,
        ),
        "return_reasons": lambda: shaped(
            raw("lineitem").select(flag).distinct(),
            "return_reasons",
            return_reason_id=reason_id,
            is_returned=flag == "R",
            is_updated=flag == "A",
        ),
        "transaction_types": transaction_types,
        "transactions": transactions,
        "delivery_points": delivery_points,
    }
