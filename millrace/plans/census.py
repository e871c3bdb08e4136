"""Census table: grouped statistics of persons. Missing keys form no group."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.numeric import right_closed_bin
from millrace.functions.text import prefix_label
from millrace.operators import aggregates as agg
from millrace.operators import rows
from millrace.operators.callbacks import GroupRule, keep_groups_by
from millrace.operators.quantiles import describe_groups
from millrace.plans.registry import job
from millrace.plans.roles import Roles
from millrace.session import written

# Age bins closed on the right, the first one also on the left.
AGE_EDGES = (16, 34, 70, 100)
AGE_LABELS = ("young", "adult", "retiree")
_BIN_SQL = """case when age < 16 then null when age <= 34 then 'young' when age <= 70 then 'adult'
    when age <= 100 then 'retiree' end"""
_MARRIED_SQL = "case when starts_with(marital_status, 'red') then 'Married' else 'Single' end"


def with_age_group(people: DataFrame) -> DataFrame:
    return people.withColumn("age_group", right_closed_bin(F.col("age"), AGE_EDGES, AGE_LABELS))


def with_is_married(people: DataFrame, prefix: str = "red") -> DataFrame:
    label = prefix_label(F.col("marital_status"), prefix, "Married", "Single")
    return people.withColumn("is_married", label)


_ALL = "person_id, age, sex, salary, education, race, occupation, hours, native_country, marital_status"


@job(f"select {_ALL} from v_census order by {_ALL} limit 10")
def preview(t: Roles) -> DataFrame:
    """First rows; person_id is not unique, so all columns give the order."""
    return rows.preview(t.census, [c.strip() for c in _ALL.split(",")], 10)


@job("select person_id, age, hours from v_census where sex = 'Male'")
def filter_equals(t: Roles) -> DataFrame:
    return rows.filter_equals(t.census, sex="Male").select("person_id", "age", "hours")


@job("""with top as (select * from v_census where hours = (select max(hours) from v_census))
    select salary, count(*) as n, count(*) * 100.0 / (select count(*) from top) as percent
    from top group by salary""")
def filter_at_max(t: Roles) -> DataFrame:
    """Persons at the largest number of hours: their count and share per class."""
    per_class = t.census.groupBy("hours", "salary").agg(F.count(F.lit(1)).alias("n"))
    # Written, as the maximum and the rows both come from it.
    counts = rows.filter_at_max(written(per_class, "hours"), "hours").select("salary", "n")
    total = counts.agg(F.sum("n")).scalar()
    return counts.select("salary", "n", (F.col("n") * 100.0 / total).alias("percent"))


@job("""select coalesce(bool_and(coalesce(education in ('1-URGENT', '2-HIGH'), false)), true) as all_in
    from v_census where salary = '>50K'""")
def isin_all(t: Roles) -> DataFrame:
    rich = t.census.where(F.col("salary") == ">50K")
    return rows.all_in_list(rich, "education", ["1-URGENT", "2-HIGH"], "all_in")


@job(f"select person_id, marital_status, {_MARRIED_SQL} as is_married from v_census")
def label_by_prefix(t: Roles) -> DataFrame:
    return with_is_married(t.census).select("person_id", "marital_status", "is_married")


@job(f"select person_id, age, {_BIN_SQL} as age_group from v_census")
def bin_right_closed(t: Roles) -> DataFrame:
    return with_age_group(t.census).select("person_id", "age", "age_group")


@job("select sex, count(*) as n from v_census where sex is not null group by sex")
def value_counts(t: Roles) -> DataFrame:
    return agg.value_counts(t.census, "sex")


@job("""select native_country, count(*) / (select count(native_country) from v_census) as share
    from v_census where native_country is not null group by native_country""")
def value_share(t: Roles) -> DataFrame:
    return agg.value_shares(t.census, "native_country")


@job(f"""with p as (select {_MARRIED_SQL} as is_married, salary from v_census where sex = 'Male')
    select is_married, salary, count(*) / sum(count(*)) over (partition by is_married) as share
    from p group by is_married, salary""")
def group_value_share(t: Roles) -> DataFrame:
    men = with_is_married(rows.filter_equals(t.census, sex="Male"))
    return agg.group_value_shares(men, "is_married", "salary")


@job(f"""with p as (select {_MARRIED_SQL} as g, salary from v_census where sex = 'Male'),
    s as (select g, avg(case when salary = '>50K' then 1.0 else 0.0 end) as share from p group by g)
    select case when (select share from s where g = 'Married') > (select share from s where g = 'Single')
    then 'Married' else 'Single' end as larger""")
def compare_groups(t: Roles) -> DataFrame:
    men = with_is_married(rows.filter_equals(t.census, sex="Male"))
    return agg.larger_share(men, "is_married", "salary", ">50K", "Married", "Single")


@job("select avg(age) as mean from v_census where sex = 'Male'")
def mean_filtered(t: Roles) -> DataFrame:
    return agg.mean_where(t.census, F.col("sex") == "Male", "age")


@job("""select salary, avg(age) as mean, round(stddev_samp(age), 6) as std
    from v_census where salary is not null group by salary""")
def group_mean_std(t: Roles) -> DataFrame:
    return agg.mean_std(t.census, "salary", "age").withColumn("std", F.round("std", 6))


@job("""select race, sex, count(age) as count, avg(age) as mean, round(stddev_samp(age), 6) as std,
    min(age) as min, quantile_cont(age, 0.25) as q25, quantile_cont(age, 0.5) as q50,
    quantile_cont(age, 0.75) as q75, max(age) as max
    from v_census where race is not null and sex is not null group by race, sex""")
def group_describe(t: Roles) -> DataFrame:
    """Age in whole years has few values, so one pass is enough."""
    stats = describe_groups(t.census, ["race", "sex"], "age", few_values=True)
    return stats.withColumn("std", F.round("std", 6))


@job("select max(age) as max from v_census where race = 'BUILDING' and sex = 'Male'")
def group_lookup(t: Roles) -> DataFrame:
    return agg.stat_of_group(t.census, F.max("age").alias("max"), race="BUILDING", sex="Male")


@job("""select native_country, salary, avg(hours) as mean from v_census
    where native_country is not null and salary is not null group by native_country, salary""")
def group_mean_2key(t: Roles) -> DataFrame:
    return agg.group_means(t.census, ["native_country", "salary"], "hours")


@job(f"""with p as (select {_BIN_SQL} as age_group from v_census where salary = '>50K')
    select l.age_group, count(p.age_group) as n
    from (values ('young'), ('adult'), ('retiree'), ('centenarian')) l(age_group)
    left join p on p.age_group = l.age_group group by l.age_group""")
def group_size_categorical(t: Roles) -> DataFrame:
    """Declared labels, one of which no bin uses: it must appear with zero."""
    rich = with_age_group(t.census.where(F.col("salary") == ">50K"))
    return agg.group_sizes_declared(rich, "age_group", [*AGE_LABELS, "centenarian"])


@job(f"""with p as (select {_BIN_SQL} as age_group, salary from v_census)
    select age_group as top from p where age_group is not null group by age_group
    order by avg(case when salary = '>50K' then 1.0 else 0.0 end) desc,
    case age_group when 'young' then 1 when 'adult' then 2 else 3 end limit 1""")
def group_argmax_share(t: Roles) -> DataFrame:
    return agg.group_with_top_share(with_age_group(t.census), "age_group", "salary", ">50K", AGE_LABELS)


_KEPT_SQL = """select occupation from v_census where occupation is not null group by occupation
    having avg(age) <= 65 and bool_and(coalesce(hours >= 1, false))"""


def _kept(t: Roles) -> DataFrame:
    rule = (F.avg("age") <= 65) & agg.all_rows(F.col("hours") >= 1)
    return agg.keep_groups(t.census, "occupation", rule)


@job(f"select person_id, occupation, age, hours from v_census where occupation in ({_KEPT_SQL})")
def group_filter(t: Roles) -> DataFrame:
    """All persons of the occupations that meet the rule."""
    return _kept(t).select("person_id", "occupation", "age", "hours")


def _rule() -> GroupRule:
    """The same rule as a user's function over parts of a group."""
    return GroupRule(
        start=lambda: (0, 0, True),
        fold=lambda state, rows: (
            state[0] + int(rows["age"].sum()),
            state[1] + int(rows["age"].count()),
            state[2] and bool((rows["hours"].dropna() >= 1).all()),
        ),
        merge=lambda a, b: (a[0] + b[0], a[1] + b[1], a[2] and b[2]),
        keep=lambda state: state[1] > 0 and state[0] <= 65 * state[1] and state[2],
    )


@job(f"select person_id, occupation, age, hours from v_census where occupation in ({_KEPT_SQL})")
def group_filter_callback(t: Roles) -> DataFrame:
    """The groups kept by a user's function; a group is folded by all tasks that have rows of it."""
    persons = t.census.select("person_id", "occupation", "age", "hours")
    return keep_groups_by(persons, ["occupation"], ["age", "hours"], _rule())


@job(_KEPT_SQL)
def group_filter_names(t: Roles) -> DataFrame:
    return _kept(t).select("occupation").distinct()


@job("select occupation, count(*) as n from v_census where occupation is not null group by occupation")
def group_size(t: Roles) -> DataFrame:
    return agg.group_sizes(t.census, "occupation")


@job("select distinct education from v_census where salary = '>50K'")
def distinct_values(t: Roles) -> DataFrame:
    rich = t.census.where(F.col("salary") == ">50K")
    return agg.distinct_in_order(rich, "education", "person_id")
