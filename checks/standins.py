"""Cubes, hierarchies and rule tables derived from the test tables.

Areas are customers (code C<key>), so every cube and every code list grows with the data. Regions 0-2
have nations as a level-4 parent, the others none. Every row of the tables takes part; remainders of
the customer key only decide which areas have the gaps, spelling changes and odd codes that the operators
are about. Only rules of fixed size are literal.
"""

from __future__ import annotations

from functools import cache, cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallycube.operators.reshape import to_cube_value
from tallycube.schema import POPULATION, Dims
from tallycube.session import configure, stored
from tallycube.sources import literal_table, read_table

YEARS = [str(y) for y in range(1995, 2002)]
COMMON_YEAR = 1998
ITEM_DIMS = Dims(item="measuredItemCPC")
REQUESTED = ["5419", "5622", "5999"]
D = POPULATION


def cents(amount: str) -> Column:
    """Amount with two decimals as a whole number, whose sums are exact and cheap."""
    return F.round(F.col(amount) * 100).cast("bigint")


def money(total: Column) -> Column:
    return (total.cast("decimal(20,0)") * F.lit("0.01").cast("decimal(3,2)")).cast("decimal(28,6)")


def tagged(letter: str, key: str) -> Column:
    return F.concat(F.lit(letter), F.col(key).cast("string"))


class Standins:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark = configure(spark)
        self.folder = folder

    @cache
    def table(self, name: str) -> DataFrame:
        return read_table(self.spark, f"{self.folder}/{name}.parquet")

    def settled(self) -> Standins:
        """The same with the leaf cube written and read back, for queries that write many tables made of it."""
        other = Standins(self.spark, self.folder)
        other.__dict__["leaf"] = stored(self.leaf, "leaf")
        return other

    # --- population cube ---

    @cached_property
    def customers(self) -> DataFrame:
        """k, nk, name and area of each customer."""
        return self.table("customer").select(
            F.col("c_custkey").alias("k"), F.col("c_nationkey").alias("nk"), F.col("c_name").alias("name")
        ).withColumn("area", tagged("C", "k"))

    @cached_property
    def session_areas(self) -> DataFrame:
        """Areas a user has picked: all market segments but one."""
        picked = self.table("customer").filter("c_mktsegment <> 'FURNITURE'")
        return picked.select(tagged("C", "c_custkey").alias("code"))

    @cached_property
    def placed(self) -> DataFrame:
        """Customers with their region rk."""
        nation = self.table("nation").select(F.col("n_nationkey").alias("nk"), F.col("n_regionkey").alias("rk"))
        return self.customers.join(nation, "nk")

    @cached_property
    def full_cube(self) -> DataFrame:
        """k, nk, element, year, value: five elements without gaps."""
        orders = self.table("orders").select(
            F.col("o_custkey").alias("k"),
            F.year("o_orderdate").alias("yr"),
            cents("o_totalprice").alias("p"),
            (F.col("o_orderstatus") == "F").alias("male"),
            F.col("o_orderpriority").isin("1-URGENT", "2-HIGH").alias("urban"),
        )
        nations = self.table("customer").select(F.col("c_custkey").alias("k"), F.col("c_nationkey").alias("nk"))
        # One row per customer and year leaves the aggregation; it is spread over elements afterwards.
        cells = orders.groupBy("k", "yr").agg(
            money(F.sum("p")).alias("e511"),
            money(F.sum(F.when(F.col("male"), F.col("p")).otherwise(0))).alias("e512"),
            money(F.sum(F.when(~F.col("male"), F.col("p")).otherwise(0))).alias("e513"),
            money(F.sum(F.when(F.col("urban"), F.col("p")).otherwise(0))).alias("e561"),
            money(F.sum(F.when(~F.col("urban"), F.col("p")).otherwise(0))).alias("e551"),
        )
        elements = ("511", "512", "513", "561", "551")
        parts = F.array(*[F.struct(F.lit(e).alias("element"), F.col(f"e{e}").alias("v")) for e in elements])
        return (
            cells.join(nations, "k")
            .select("k", "nk", "yr", F.explode(parts).alias("x"))
            .select("k", "nk", "x.element", "yr", "x.v")
        )

    @cached_property
    def leaf(self) -> DataFrame:
        """What the areas report: the full cube with gaps, missing values and flags."""
        sexes, places = F.col("element").isin("512", "513"), F.col("element").isin("551", "561")
        rows = self.full_cube.filter(
            ~(sexes & F.expr("k % 7 = 3 and nk % 3 = 0"))
            & ~(places & F.expr("k % 11 = 4 and nk % 4 = 1"))
            & ~((F.col("element") == "513") & F.expr("k % 101 = 5"))
        )
        return to_cube_value(
            rows.select(
                tagged("C", "k").alias(D.area),
                F.col("element").alias(D.element),
                F.col("yr").alias(D.year),
                F.expr("if(k % 211 = 0 and yr = 1996, null, v)").alias(D.value),
                F.expr("case when k % 13 = 0 then '' when yr >= 2000 then 'E' else 'X' end").alias(D.status),
                F.lit("h").alias(D.method),
            )
        )

    @cached_property
    def published(self) -> DataFrame:
        """What the publisher states for the parents, under its own codes."""
        parent = self.placed.select("k", F.expr("if(rk < 3, concat('N', nk), concat('R', rk))").alias("parent"))
        sums = self.full_cube.join(parent, "k").groupBy("parent", "element", "yr").agg(F.sum("v").alias("v"))
        return to_cube_value(
            sums.select(
                F.concat(F.lit("U"), "parent").alias(D.area),
                F.col("element").alias(D.element),
                F.col("yr").alias(D.year),
                F.col("v").alias(D.value),
                F.lit("X").alias(D.status),
                F.lit("h").alias(D.method),
            )
        )

    @cached_property
    def source(self) -> DataFrame:
        return self.leaf.unionByName(self.published)

    @cached_property
    def hierarchy(self) -> DataFrame:
        return self.placed.select(
            F.lit("W").alias("code_l1"),
            tagged("R", "rk").alias("code_l3"),
            F.expr("case when rk < 3 then concat('N', nk) when nk % 2 = 0 then '' end").alias("code_l4"),
            F.col("area").alias("code_l5"),
        )

    @cached_property
    def conversion(self) -> DataFrame:
        """Published code to residual code; one parent (N6) has none."""
        nation = self.table("nation").select(
            F.expr("if(n_regionkey < 3, concat('N', n_nationkey), concat('R', n_regionkey))").alias("parent")
        )
        return (
            nation.distinct()
            .filter("parent <> 'N6'")
            .select(F.concat(F.lit("U"), "parent").alias("source_code"), F.concat("parent", F.lit(".01")).alias("residual_code"))
        )

    # --- code lists ---

    @cached_property
    def area_codes(self) -> DataFrame:
        return self.customers.filter("k % 43 <> 0").select(
            F.col("area").alias("code"),
            F.expr("if(k % 41 = 0, null, name)").alias("description"),
            F.expr("if(k % 29 = 0, 'region', 'country')").alias("type"),
            F.expr("k % 31 = 0").alias("selectionOnly"),
            F.expr("if(k % 37 = 0, '1999', null)").alias("endDate"),
        )

    @cached_property
    def source_codes(self) -> DataFrame:
        return self.customers.filter("k % 97 <> 1").select(
            F.col("area").alias("code"), F.expr("if(k % 71 = 3, null, name)").alias("source_description")
        )

    @cached_property
    def target_codes(self) -> DataFrame:
        """Some names changed, some taken from the neighbour."""
        name = F.expr(
            "case when k % 50 = 0 then concat(name, '*') "
            "when k % 100 = 51 then concat('Customer#', lpad(cast(k - 1 as string), 9, '0')) else name end"
        )
        return self.customers.filter("k % 89 <> 2").select(F.col("area").alias("code"), name.alias("target_description"))

    @cached_property
    def approved(self) -> DataFrame:
        return self.customers.filter("k % 100 = 0").select(F.col("area").alias("code"))

    @cached_property
    def validity(self) -> DataFrame:
        spans = F.expr(
            "case when k % 5 = 0 then array(struct(cast(null as int) as s, 1999 as e)) "
            "when k % 5 = 1 then array(struct(1997 as s, cast(null as int) as e)) "
            "when k % 5 = 2 then array(struct(cast(null as int) as s, 1996 as e), struct(1996 as s, 1996 as e), "
            "struct(1998 as s, cast(null as int) as e)) "
            "else array(struct(cast(null as int) as s, cast(null as int) as e)) end"
        )
        return (
            self.customers.filter("k % 24 <> 0")
            .select("area", F.explode(spans).alias("x"))
            .select(F.col("area").alias("m49"), F.col("x.s").alias("start_year"), F.col("x.e").alias("end_year"))
        )

    # --- groups and item cube ---

    @cached_property
    def area_groups(self) -> DataFrame:
        """Members of nation groups, region groups and the world, with copies, nulls and nested groups."""
        codes = F.expr(
            "array(struct(concat('G', nk) as g, area as m), struct(concat('GR', rk) as g, area as m), "
            "struct('953' as g, area as m), struct('953' as g, if(k % 7 = 0, area, null) as m))"
        )
        areas = self.placed.select(F.explode(codes).alias("x")).select(
            F.col("x.g").alias("group_code"), F.col("x.m").alias("member_code")
        )
        nested = self.table("nation").select(
            tagged("GR", "n_regionkey").alias("group_code"), tagged("G", "n_nationkey").alias("member_code")
        )
        return areas.unionByName(nested)

    @cached_property
    def item_groups(self) -> DataFrame:
        rows = [
            ("I1", "ECONOMY", 1.0),
            ("I1", "ECONOMY", 0.25),
            ("I1", "PROMO", None),
            ("I1", "STANDARD", 0.5),
            ("I2", "SMALL", 0.33333333),
            ("I2", "MEDIUM", 2.0),
            ("I2", "STANDARD", 0.00004),
        ]
        return literal_table(self.spark, rows, "group_code string, member_code string, factor double")

    @cached_property
    def items(self) -> DataFrame:
        """Cube with an item dimension: customer, part type, year of shipping."""
        lines = self.table("lineitem").select(
            "l_orderkey",
            "l_partkey",
            F.year("l_shipdate").alias("yr"),
            cents("l_extendedprice").alias("x"),
            cents("l_quantity").alias("q"),
        )
        orders = self.table("orders").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("k"))
        parts = self.table("part").select(
            F.col("p_partkey").alias("l_partkey"),
            F.expr(
                "case when p_partkey % 40 = 0 then 'I1' when p_partkey % 53 = 0 then 'AH01' else p_type end"
            ).alias("item"),
        )
        cells = (
            lines.join(parts, "l_partkey")
            .join(orders, "l_orderkey")
            .groupBy("k", "item", "yr")
            .agg(money(F.sum("x")).alias("x"), money(F.sum("q")).alias("q"))
        )
        rows = F.expr(
            "array(struct('5510' as e, x as v, true as has), "
            "struct('5312' as e, if(k % 19 = 4, null, q) as v, true as has), "
            "struct('5622' as e, if(item = 'LARGE' and k % 2 = 0, null, x) as v, true as has), "
            "struct('5419' as e, 0 as v, k % 25 <> 0 as has), "
            "struct('5999' as e, q as v, true as has))"
        )
        return to_cube_value(
            cells.select("k", "item", "yr", F.explode(rows).alias("r"))
            .filter("r.has")
            .select(
                F.expr("if(k % 61 = 0, 'GR1', concat('C', k))").alias(ITEM_DIMS.area),
                F.col("r.e").alias(ITEM_DIMS.element),
                F.col("item").alias(ITEM_DIMS.item),
                F.col("yr").alias(ITEM_DIMS.year),
                F.col("r.v").alias(ITEM_DIMS.value),
                F.expr("case when k % 13 = 0 then null when yr >= 2000 then 'E' else 'X' end").alias(ITEM_DIMS.status),
                F.lit("h").alias(ITEM_DIMS.method),
            )
        )

    @cached_property
    def calculated(self) -> DataFrame:
        rows = [("5419", "5510", "5312", 10.0), ("664", "5510", "5312", 1.0), ("5622", "5510", "5319", 1.0)]
        return literal_table(
            self.spark, rows, "result_var_code string, num_var_code string, den_var_code string, mult double"
        )

    @cached_property
    def flag_weights(self) -> DataFrame:
        return literal_table(self.spark, [("X", 1.0), ("E", 0.5), (None, 1.0), ("", 2.0)], "flag string, weight double")

    @cached_property
    def area_rules(self) -> DataFrame:
        return self.customers.select(
            F.expr("if(k % 33 = 0, 'Trade Flow', 'Population')").alias("domain_name"),
            F.col("area").alias("code"),
            F.expr(
                "case when k % 17 = 0 then 0 when k % 18 = 0 then null when k % 2 = 0 then 99 else 1 end"
            ).alias("flag"),
        )

    @cached_property
    def item_rules(self) -> DataFrame:
        rows = [
            ("Population", "ECONOMY", 99),
            ("Population", "PROMO", 1),
            ("Population", "STANDARD", 99),
            ("Population", "SMALL", 99),
            ("Population", "MEDIUM", 0),
            ("Trade Flow", "MEDIUM", 99),
            ("Population", "LARGE", None),
        ]
        return literal_table(self.spark, rows, "domain_name string, code string, flag int")

    @cached_property
    def excluded(self) -> DataFrame:
        return literal_table(self.spark, [("5999",), ("5998",)], "element_code string")

    @cached_property
    def requested(self) -> DataFrame:
        """Elements asked for, out of those the item cube holds."""
        wanted = self.items.filter(F.col(ITEM_DIMS.element).isin(REQUESTED))
        return wanted.select(F.col(ITEM_DIMS.element).alias("code")).distinct()

    # --- wide tables ---

    def wide(self, element: str, variant: str | None = None) -> DataFrame:
        """Text table, one column per year, with blank thousands separators and a bad cell here and there."""
        cells = self.leaf.filter(F.col(D.element) == element)
        # Numbers are picked per year first and written as text afterwards.
        wide = cells.groupBy(D.area).agg(*[F.max(F.when(F.col(D.year) == int(y), F.col(D.value))).alias(y) for y in YEARS])
        key = F.substring(D.area, 2, 20).cast("bigint")
        text = {y: F.regexp_replace(F.format_number(y, 2), ",", " ") for y in YEARS}
        text["1996"] = F.when(key % 67 == 0, F.lit("..")).otherwise(text["1996"])
        ids = [F.col(D.area).alias("Country code")]
        if variant:
            ids.insert(0, F.lit(variant).alias("Variant"))
        return wide.select(*ids, *[text[y].alias(y) for y in YEARS])

    def estimates(self, element: str) -> DataFrame:
        years = [y for y in YEARS if int(y) <= COMMON_YEAR]
        return self.wide(element, "Estimates").select("Variant", "Country code", *years)

    def medium(self, element: str) -> DataFrame:
        """Projections, whose common year disagrees for some areas."""
        years = [y for y in YEARS if int(y) >= COMMON_YEAR]
        other = F.substring("Country code", 2, 20).cast("bigint") % 37 == 0
        return self.wide(element, "Medium variant").select(
            "Variant",
            "Country code",
            *[F.when(other, F.lit("1 234.50")).otherwise(F.col(y)).alias(y) if y == str(COMMON_YEAR) else y for y in years],
        )

    @cached_property
    def sections(self) -> dict[str, dict[str, DataFrame]]:
        roles = {"total": "511", "male": "512", "female": "513"}
        found = {r: {"estimates": self.estimates(e), "medium": self.medium(e)} for r, e in roles.items()}
        return {**found, "urban": {"estimates": self.wide("561")}, "rural": {"estimates": self.wide("551")}}

    # --- a second publication ---

    @cached_property
    def second(self) -> DataFrame:
        """The leaf cube as another office prints it: some values scaled, a year and areas missing, areas added."""
        key = F.substring(D.area, 2, 20).cast("bigint")
        value = F.when(key % 6 == 0, (F.col(D.value) * F.lit("1.5").cast("decimal(3,1)")).cast("decimal(28,6)")).otherwise(
            F.col(D.value)
        )
        kept = self.leaf.filter((F.col(D.year) != 1997) & (key % 10 != 9)).withColumn(D.value, value)
        codes = F.when(key % 77 == 0, F.array(F.col(D.area), F.concat(F.lit("Z"), D.area))).otherwise(F.array(F.col(D.area)))
        return kept.withColumn(D.area, F.explode(codes))
