"""Role tables: the tables the jobs talk about, derived from the given ones.

Each role exists as a DataFrame (properties of ``Roles``) and as SQL text for
the independent check (``ROLE_SQL``).
"""

from __future__ import annotations

from functools import cached_property, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.keys import numbered_parts
from millrace.session import written
from millrace.sources.readers import literal_rows

AS_OF = "2020-06-15"
# The ratings in their order.
RATINGS = ("G", "PG", "PG-13", "R", "NC-17")
CATEGORIES = ("STANDARD", "ECONOMY", "MEDIUM", "SMALL", "LARGE", "PROMO", "ARCHIVE")


class Roles:
    """Lazily built role tables over one folder of Parquet tables."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self._tables: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        """A given table; its schema is looked up once for each set of role tables."""
        if name not in self._tables:
            self._tables[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._tables[name]

    # --- rooms and students
    @cached_property
    def rooms(self) -> DataFrame:
        name = F.concat(F.lit("room-"), (F.col("o_orderkey") % 1000).cast("string"))
        return self.table("orders").select(F.col("o_orderkey").alias("id"), name.alias("name"))

    @cached_property
    def students(self) -> DataFrame:
        return self.table("lineitem").select(
            _line_id().alias("id"),
            F.to_date("l_shipdate").alias("birthday"),
            F.col("l_returnflag").alias("sex"),
            F.col("l_orderkey").alias("room"),
        )

    # --- film rental
    @cached_property
    def category(self) -> DataFrame:
        listed = literal_rows(self.spark, CATEGORIES, "_at", "name")
        return listed.select((F.col("_at") + 1).alias("category_id"), "name")

    @cached_property
    def film(self) -> DataFrame:
        key = F.col("p_partkey")
        return self.table("part").select(
            key.alias("film_id"),
            F.concat_ws(" ", "p_name", key.cast("string")).alias("title"),
            F.col("p_brand").alias("description"),
            (3 + key % 5).alias("rental_duration"),
            (F.lit(0.99) + key % 5).cast("decimal(4,2)").alias("rental_rate"),
            F.col("p_size").alias("length"),
            F.get(F.array(*[F.lit(r) for r in RATINGS]), (key % 5).cast("int")).alias("rating"),
        )

    @cached_property
    def film_category(self) -> DataFrame:
        # The category ids are the places in a fixed list: looked up, not joined.
        place = F.array_position(F.array(*[F.lit(c) for c in CATEGORIES]), F.col("p_type")).cast("int")
        placed = self.table("part").select(F.col("p_partkey").alias("film_id"), place.alias("category_id"))
        return placed.where("category_id > 0")

    @cached_property
    def actor(self) -> DataFrame:
        return self.table("supplier").select(
            F.col("s_suppkey").alias("actor_id"), *_names("s_name")
        )

    @cached_property
    def film_actor(self) -> DataFrame:
        line = self.table("lineitem")
        return line.select(F.col("l_suppkey").alias("actor_id"), F.col("l_partkey").alias("film_id")).distinct()

    @cached_property
    def inventory(self) -> DataFrame:
        copies = self.table("part").select("p_partkey").withColumn("k", F.explode(F.array(F.lit(0), F.lit(1))))
        return copies.select(
            (F.col("p_partkey") * 2 + F.col("k")).alias("inventory_id"),
            F.col("p_partkey").alias("film_id"),
            (F.col("k") + 1).alias("store_id"),
        )

    @property
    def _orders(self) -> DataFrame:
        return self.table("orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey", "o_orderdate")

    @cached_property
    def _numbered_lines(self) -> DataFrame:
        """Every order line with an id of its own: order, line number, and place among lines of equal number.

        Written once for all roles that name lines.
        """
        parts = numbered_parts(self.table("lineitem"), ["l_orderkey", "l_linenumber"], _LINE_ORDER, "_place", by=["l_orderkey"])
        used = ["line", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice", "l_linestatus", "l_shipdate", "o_custkey", "o_orderdate"]

        def ordered(lines: DataFrame) -> DataFrame:
            """Dealt by order already, lines are not shuffled again."""
            named = lines.withColumn("line", _line_id() * 1_000_000 + F.col("_place"))
            return named.join(self._orders, "l_orderkey").select(*used)

        return written(reduce(DataFrame.unionAll, map(ordered, parts)), "lines")

    @cached_property
    def rental_facts(self) -> DataFrame:
        """Rentals without their ids, straight from the lines."""
        return self.table("lineitem").join(self._orders, "l_orderkey").select(*_rental_columns())

    @cached_property
    def rental(self) -> DataFrame:
        return self._numbered_lines.select(F.col("line").alias("rental_id"), *_rental_columns())

    @cached_property
    def payment_facts(self) -> DataFrame:
        """Payments without their ids, straight from the lines."""
        return self.table("lineitem").join(self._orders, "l_orderkey").select(*_payment_columns())

    @cached_property
    def payment(self) -> DataFrame:
        line = F.col("line")
        return self._numbered_lines.select(line.alias("payment_id"), line.alias("rental_id"), *_payment_columns())

    @cached_property
    def address(self) -> DataFrame:
        """Even ids are customers', odd ones suppliers'."""

        def of(table: str, letter: str, odd: int) -> DataFrame:
            key, nation = F.col(f"{letter}_{'cust' if letter == 'c' else 'supp'}key"), F.col(f"{letter}_nationkey")
            return self.table(table).select(
                (key * 2 + odd).alias("address_id"),
                F.concat(key.cast("string"), F.lit(" "), F.split_part(F.col(f"{letter}_name"), F.lit("#"), F.lit(1)), F.lit(" Street")).alias("address"),
                F.lpad((nation * 1000 + key % 1000).cast("string"), 5, "0").alias("postal_code"),
                F.concat((nation + 10).cast("string"), F.lit("-"), F.lpad((key % 10000000).cast("string"), 7, "0")).alias("phone"),
                nation.alias("city_id"),
            )

        return of("customer", "c", 0).unionAll(of("supplier", "s", 1))

    @cached_property
    def customer(self) -> DataFrame:
        key = F.col("c_custkey")
        return self.table("customer").select(
            key.alias("customer_id"),
            *_names("c_name"),
            F.when(F.col("c_acctbal") < 0, 0).otherwise(1).alias("active"),
            (key * 2).alias("address_id"),
            (key % 2 + 1).alias("store_id"),
        )

    @cached_property
    def city(self) -> DataFrame:
        key = F.col("n_nationkey")
        suffix = F.when(key % 5 == 0, "-X").otherwise("")
        return self.table("nation").select(
            key.alias("city_id"),
            F.concat("n_name", suffix).alias("city"),
            F.col("n_regionkey").alias("country_id"),
        )

    @cached_property
    def country(self) -> DataFrame:
        return self.table("region").select(
            F.col("r_regionkey").alias("country_id"), F.col("r_name").alias("country")
        )

    @cached_property
    def staff(self) -> DataFrame:
        return self.table("supplier").select(
            F.col("s_suppkey").alias("staff_id"),
            *_names("s_name"),
            (F.col("s_suppkey") * 2 + 1).alias("address_id"),
            (F.col("s_suppkey") % 2 + 1).alias("store_id"),
        )

    @cached_property
    def store(self) -> DataFrame:
        return self.spark.sql("SELECT * FROM VALUES (1, 1, 3), (2, 2, 5) t(store_id, manager_staff_id, address_id)")

    # --- census, series, reviews
    @cached_property
    def census(self) -> DataFrame:
        line = self.table("lineitem")
        part, orders = self.table("part"), self.table("orders")
        customer, nation = self.table("customer"), self.table("nation")
        joined = (
            line.join(part, line["l_partkey"] == part["p_partkey"])
            .join(orders, line["l_orderkey"] == orders["o_orderkey"])
            .join(customer, orders["o_custkey"] == customer["c_custkey"])
            .join(nation, customer["c_nationkey"] == nation["n_nationkey"])
        )
        return joined.select(
            _line_id().alias("person_id"),
            (14 + 2 * F.col("p_size")).alias("age"),
            F.when(F.col("l_linestatus") == "F", "Female").otherwise("Male").alias("sex"),
            F.when(F.col("o_totalprice") > 250000, ">50K").otherwise("<=50K").alias("salary"),
            F.col("o_orderpriority").alias("education"),
            F.col("c_mktsegment").alias("race"),
            F.col("p_brand").alias("occupation"),
            F.col("l_quantity").alias("hours"),
            F.col("n_name").alias("native_country"),
            F.col("p_name").alias("marital_status"),
        )

    @cached_property
    def series(self) -> DataFrame:
        return self.table("events").select(
            F.col("user_id").alias("series_id"),
            F.col("event_id").alias("pos"),
            (F.floor("value").cast("int") % 4).alias("x"),
        )

    @cached_property
    def reviews(self) -> DataFrame:
        docs, events = self.table("documents"), self.table("events")
        at = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
        return docs.join(events, docs["doc_id"] == events["event_id"]).select(
            F.col("doc_id").alias("review_id"),
            F.col("text").alias("content"),
            F.col("value").alias("score"),
            F.when(F.col("doc_id") % 17 == 0, "bad")
            .when(F.col("doc_id") % 17 == 1, F.date_format("ts", "yyyy-M-d H:mm:ss"))
            .otherwise(at)
            .alias("at_text"),
        )


def _line_id():
    return F.col("l_orderkey") * 10 + F.col("l_linenumber")


def _rental_columns():
    back = F.date_add(F.to_date("o_orderdate"), F.col("l_quantity").cast("int")).cast("timestamp_ntz")
    return (
        F.col("o_orderdate").alias("rental_date"),
        (F.col("l_partkey") * 2 + F.col("l_linenumber") % 2).alias("inventory_id"),
        F.col("o_custkey").alias("customer_id"),
        F.when(F.col("l_linestatus") == "F", back).alias("return_date"),
    )


def _payment_columns():
    whole = F.floor(F.col("l_extendedprice") / 1000).cast("int")
    return (
        F.col("o_custkey").alias("customer_id"),
        (whole + F.lit("0.99").cast("decimal(3,2)")).cast("decimal(5,2)").alias("amount"),
        F.col("l_shipdate").alias("payment_date"),
    )


def _names(full: str):
    part = lambda n: F.split_part(F.col(full), F.lit("#"), F.lit(n))
    return part(1).alias("first_name"), part(2).alias("last_name")


# All other columns of a line: what still ties is a repeated row.
_LINE_ORDER = (
    "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"
)

# Fixed texts: the same roles as SQL, in the order in which they may refer to each other.
ROLE_SQL = {
    "v_rooms": "select o_orderkey as id, concat('room-', o_orderkey % 1000) as name from orders",
    "v_students": """select l_orderkey*10+l_linenumber as id, cast(l_shipdate as date) as birthday,
        l_returnflag as sex, l_orderkey as room from lineitem""",
    "v_category": """select * from (values (1,'STANDARD'),(2,'ECONOMY'),(3,'MEDIUM'),(4,'SMALL'),
        (5,'LARGE'),(6,'PROMO'),(7,'ARCHIVE')) t(category_id,name)""",
    "v_film": """select p_partkey as film_id, concat(p_name,' ',p_partkey) as title, p_brand as description,
        3 + p_partkey % 5 as rental_duration, cast(0.99 + p_partkey % 5 as decimal(4,2)) as rental_rate,
        p_size as length, case p_partkey % 5 when 0 then 'G' when 1 then 'PG' when 2 then 'PG-13' when 3 then 'R'
        else 'NC-17' end as rating from part""",
    "v_film_category": "select p_partkey as film_id, category_id from part join v_category on name=p_type",
    "v_actor": """select s_suppkey as actor_id, split_part(s_name,'#',1) as first_name,
        split_part(s_name,'#',2) as last_name from supplier""",
    "v_film_actor": "select distinct l_suppkey as actor_id, l_partkey as film_id from lineitem",
    "v_inventory": """select p_partkey*2+k as inventory_id, p_partkey as film_id, k+1 as store_id
        from part cross join (values (0),(1)) t(k)""",
    "v_line": """select (l_orderkey*10+l_linenumber)*1000000 + row_number() over (partition by l_orderkey, l_linenumber
        order by l_partkey nulls first, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate)
        as line, lineitem.*, o_custkey, o_orderdate from lineitem join orders on l_orderkey=o_orderkey""",
    "v_rental": """select line as rental_id, o_orderdate as rental_date, l_partkey*2+l_linenumber%2 as inventory_id,
        o_custkey as customer_id, case when l_linestatus='F' then
        cast(cast(o_orderdate as date)+cast(l_quantity as int) as timestamp) end as return_date from v_line""",
    "v_payment": """select line as payment_id, line as rental_id, o_custkey as customer_id,
        cast(cast(floor(l_extendedprice/1000) as int)+0.99 as decimal(5,2)) as amount, l_shipdate as payment_date
        from v_line""",
    "v_address": """select c_custkey*2 as address_id, c_custkey || ' ' || split_part(c_name,'#',1) || ' Street' as address,
        lpad(cast(c_nationkey*1000+c_custkey%1000 as varchar),5,'0') as postal_code,
        (c_nationkey+10) || '-' || lpad(cast(c_custkey%10000000 as varchar),7,'0') as phone, c_nationkey as city_id from customer
        union all select s_suppkey*2+1, s_suppkey || ' ' || split_part(s_name,'#',1) || ' Street',
        lpad(cast(s_nationkey*1000+s_suppkey%1000 as varchar),5,'0'),
        (s_nationkey+10) || '-' || lpad(cast(s_suppkey%10000000 as varchar),7,'0'), s_nationkey from supplier""",
    "v_customer": """select c_custkey as customer_id, split_part(c_name,'#',1) as first_name,
        split_part(c_name,'#',2) as last_name, case when c_acctbal<0 then 0 else 1 end as active,
        c_custkey*2 as address_id, c_custkey%2+1 as store_id from customer""",
    "v_city": """select n_nationkey as city_id, concat(n_name, case when n_nationkey%5=0 then '-X' else '' end)
        as city, n_regionkey as country_id from nation""",
    "v_country": "select r_regionkey as country_id, r_name as country from region",
    "v_staff": """select s_suppkey as staff_id, split_part(s_name,'#',1) as first_name, split_part(s_name,'#',2) as last_name,
        s_suppkey*2+1 as address_id, s_suppkey%2+1 as store_id from supplier""",
    "v_store": "select * from (values (1,1,3),(2,2,5)) t(store_id,manager_staff_id,address_id)",
    "v_census": """select l_orderkey*10+l_linenumber as person_id, 14+2*p_size as age,
        case when l_linestatus='F' then 'Female' else 'Male' end as sex,
        case when o_totalprice>250000 then '>50K' else '<=50K' end as salary, o_orderpriority as education,
        c_mktsegment as race, p_brand as occupation, l_quantity as hours, n_name as native_country,
        p_name as marital_status
        from lineitem join part on l_partkey=p_partkey join orders on l_orderkey=o_orderkey
        join customer on o_custkey=c_custkey join nation on c_nationkey=n_nationkey""",
    "v_series": "select user_id as series_id, event_id as pos, cast(floor(value) as int) % 4 as x from events",
    "v_reviews": """select doc_id as review_id, text as content, value as score,
        case doc_id%17 when 0 then 'bad' when 1 then strftime(ts,'%Y-%-m-%-d %-H:%M:%S')
        else strftime(ts,'%Y-%m-%d %H:%M:%S') end as at_text
        from documents join events on doc_id=event_id""",
}
_NEEDS = {"v_film_category": ("v_category",), "v_rental": ("v_line",), "v_payment": ("v_line",)}


def with_roles(sql: str) -> str:
    """Put the roles a SQL text mentions in front of it as a WITH list."""
    words = set(sql.replace("(", " ").replace(")", " ").replace(",", " ").replace(".", " ").split())
    used = {name for name in ROLE_SQL if name in words}
    for name in tuple(used):
        used.update(_NEEDS.get(name, ()))
    if not used:
        return sql.strip()
    listed = ",\n".join(f"{name} as ({text})" for name, text in ROLE_SQL.items() if name in used)
    body = sql.strip()
    if body.lower().startswith("with "):
        return f"with {listed},\n{body[5:]}"
    return f"with {listed}\n{body}"
