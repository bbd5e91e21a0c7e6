"""Employment, workforce, claims, population and housing jobs on tables in the published layouts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regiolume.catalog.registry import YEARS_SQL, Tables, query
from regiolume.operators.setops import stack
from regiolume.operators.totals import add_total, merge_buckets
from regiolume.plans import claims, employment, population, rules, workforce
from regiolume.session import scratch_folder
from regiolume.sources import read_report, write_report


def pick(index: Column, labels) -> Column:
    """Label number ``index`` (from 0) of a list."""
    return F.element_at(F.array(*[F.lit(x) for x in labels]), (index + 1).cast("int"))


def sql_list(labels) -> str:
    return "[" + ", ".join("'" + x.replace("'", "''") + "'" for x in labels) + "]"


# Jobs by sector --------------------------------------------------------------------------------

AREAS = ("Washington State", "Seattle MSA", "Tacoma MSA", "Bremerton MSA", "Olympia MSA")
SECTOR_OF = {
    "1-URGENT": "Information", "2-HIGH": "Financial Activities", "3-MEDIUM": "Leisure and Hospitality",
    "4-NOT SPECIFIED": "Construction", "5-LOW": "Other Services",
}
PRIVATE = ("Information", "Financial Activities", "Leisure and Hospitality", "Other Services")


def placed_counts(t: Tables, *keys: Column) -> DataFrame:
    """Orders per nation and further keys, counted before the join with the customers."""
    sales = t.orders.groupBy("o_custkey", *keys).agg(F.count("*").alias("n"))
    homes = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        "c_custkey", "n_nationkey", "n_regionkey"
    )
    return sales.join(homes, F.col("o_custkey") == F.col("c_custkey")).drop("o_custkey", "c_custkey")


def month_columns(t: Tables) -> list[str]:
    """First months of the quarters: the columns of the published table."""
    return [f"{y}-{m:02d}-01" for y in t.years() for m in (1, 4, 7, 10)]


def sector_tabs(t: Tables) -> DataFrame:
    """One block of rows per area, one column per month; one area hides two sectors."""
    sector = F.lit(None).cast("string")
    for priority, name in SECTOR_OF.items():
        sector = F.when(F.col("o_orderpriority") == priority, name).otherwise(sector)
    month = F.date_format(F.trunc(F.col("o_orderdate").cast("date"), "quarter"), "yyyy-MM-dd")
    rows = placed_counts(t, sector.alias("sector"), month.alias("month")).withColumn(
        "geography", pick(F.col("n_regionkey"), AREAS)
    )
    rows = add_total(rows.select("geography", "month", "sector", "n"), ["geography", "month"], "sector", ["n"], "Total Nonfarm")
    rows = merge_buckets(rows, "sector", ["geography", "month"], ["n"], {"Private Service Providing": PRIVATE})
    hidden = (F.col("geography") == "Bremerton MSA") & (F.col("sector") == "Other Services")
    merged = F.when(
        (F.col("geography") == "Bremerton MSA") & (F.col("sector") == "Construction"), "Mining, Logging, and Construction"
    ).otherwise(F.col("sector"))
    shown = rows.filter(~hidden).select("geography", merged.alias("sector"), "month", "n")
    wide = shown.groupBy("geography", "sector").pivot("month", month_columns(t)).agg(F.sum("n"))
    return wide.select(
        "geography", F.lit(0).alias("NAICS.CELL"), F.concat(F.lit("   "), F.col("sector"), F.lit(" ")).alias("NAICS.INDUSTRY"),
        *[F.coalesce(F.col(f"`{m}`"), F.lit(0)).alias(m) for m in month_columns(t)],
    )


SECTOR_SQL = f"""
  f as (select {sql_list(AREAS)}[n_regionkey + 1] as geography,
               case o_orderpriority when '1-URGENT' then 'Information' when '2-HIGH' then 'Financial Activities'
                    when '3-MEDIUM' then 'Leisure and Hospitality' when '4-NOT SPECIFIED' then 'Construction' else 'Other Services' end as sector,
               date_trunc('quarter', o_orderdate)::date as month
        from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey),
  u as (select geography, sector, month from f union all select geography, 'Total Nonfarm', month from f
        union all select geography, 'Private Service Providing', month from f where sector <> 'Construction'),
  c as (select geography, sector, month, count(*)::double as n from u group by 1, 2, 3),
  grid as (select geography, sector, make_date(y, m, 1) as month
           from (select distinct geography, sector from c), (select unnest({YEARS_SQL}) as y), (select unnest([1, 4, 7, 10]) as m)),
  j as (select geography, sector, month, coalesce(n, 0) as jobs from grid left join c using (geography, sector, month)),
  jobs as (select * from j union all
           select 'Region', sector, month, sum(jobs) from j where geography <> 'Washington State' group by 2, 3)"""


@query("job_sector_jobs", f"with {SECTOR_SQL} select * from jobs")
def job_sector_jobs(t: Tables):
    """The hidden sector comes back as the residual; the region sums all areas but the state."""
    return employment.sector_jobs(sector_tabs(t))


@query(
    "job_sector_latest",
    f"""with {SECTOR_SQL}
       select geography, sector, month, jobs, year(month)::varchar as year, strftime(month, '%B-%Y') as date,
              list_position({sql_list(rules.SECTOR_ORDER)}, sector)::int as place
       from jobs where geography = 'Region' and sector <> 'Private Service Providing' and month(month) = 10 and year(month) >= 1998""",
)
def job_sector_latest(t: Tables):
    """Sectors in the latest month of every year, in display order."""
    return employment.latest_month_by_sector(employment.sector_jobs(sector_tabs(t)), 1998)


@query(
    "job_sector_change",
    f"""with {SECTOR_SQL}, r as (select * from jobs where geography = 'Region' and sector = 'Total Nonfarm' and month(month) = 7
                                 and year(month) >= 1996)
       select geography, sector, month, jobs, jobs - lag(jobs) over (order by month) as delta from r""",
)
def job_sector_change(t: Tables):
    return employment.yearly_change(employment.sector_jobs(sector_tabs(t)), 7, 1996)


@query(
    "job_total_jobs",
    f"""with {SECTOR_SQL}
       select geography, sector, month, jobs, year(month)::varchar as year, strftime(month, '%B-%Y') as date
       from jobs where geography in ('Region', 'Washington State') and sector = 'Total Nonfarm'""",
)
def job_total_jobs(t: Tables):
    """The region next to the state, over all months."""
    return employment.total_jobs(employment.sector_jobs(sector_tabs(t)), t.years().start)


@query(
    "job_monthly_change",
    f"""with {SECTOR_SQL}, r as (select * from jobs where geography = 'Region' and sector = 'Total Nonfarm')
       select geography, sector, month, jobs, jobs - lag(jobs) over (order by month) as delta from r""",
)
def job_monthly_change(t: Tables):
    return employment.monthly_change(employment.sector_jobs(sector_tabs(t)), t.years().start)


@query(
    "job_lowest_month",
    f"""with {SECTOR_SQL}, r as (select * from jobs where geography = 'Region' and sector = 'Total Nonfarm' and year(month) = 1999)
       select * from r where jobs = (select min(jobs) from r)""",
)
def job_lowest_month(t: Tables):
    return employment.lowest_month(employment.sector_jobs(sector_tabs(t)), 1999)


# Workforce -------------------------------------------------------------------------------------

QUARTER = "1998-01-01"
GENDERS = ("Male", "Female")
RACES = (
    "White Alone", "Asian Alone", "Black or African American Alone", "American Indian or Alaska Native Alone",
    "Native Hawaiian or Other Pacific Islander Alone", "Two or More Race Groups",
)
AGES = ("14-18", "19-21", "22-24", "25-34", "35-44", "45-54", "55-64", "65-99")
SCHOOLS = (
    "Less than high school", "High school or equivalent, no college", "Some college or Associate degree",
    "Bachelor's degree or advanced degree", "Educational attainment not available (workers aged 24 or younger)",
)


def workers_table(t: Tables, labels, key: str) -> DataFrame:
    """One row per quarter, one column per category with dots for blanks, flag columns between."""
    quarter = F.concat(F.year("o_orderdate"), F.lit(" Q"), F.quarter("o_orderdate"))
    heads = [x.replace(" ", ".") for x in labels]
    counts = [
        F.count_if(F.col(key) % len(labels) == i).cast("double").alias(h) for i, h in enumerate(heads)
    ]
    wide = t.orders.groupBy(quarter.alias("X1")).agg(*counts)
    return wide.withColumn("Flags." + heads[0], F.lit("")).withColumn("Flags", F.lit(""))


def workforce_tables(t: Tables) -> dict[str, DataFrame]:
    return {
        "gender": workers_table(t, GENDERS, "o_custkey"),
        "not_hispanic": workers_table(t, RACES, "o_orderkey"),
        "hispanic": workers_table(t, ("Hispanic or Latino", "Not Hispanic or Latino"), "o_orderkey"),
        "age": workers_table(t, AGES, "o_custkey"),
        "education": workers_table(t, SCHOOLS, "o_orderkey"),
    }


def _category_sql(name: str, labels, key: str, keep: str = "true") -> str:
    return f"""select '{name}' as category, {sql_list(labels)}[({key} % {len(labels)} + 1)::int] as demographic from q where {keep}"""


WORKFORCE_SQL = f"""
  q as (select * from orders where date_trunc('quarter', o_orderdate) = date '{QUARTER}'),
  p as ({_category_sql('Gender', GENDERS, 'o_custkey')}
        union all {_category_sql('Race', RACES, 'o_orderkey')}
        union all {_category_sql('Race', ('Hispanic or Latino', 'x'), 'o_orderkey', 'o_orderkey % 2 = 0')}
        union all {_category_sql('Age', AGES, 'o_custkey')}
        union all {_category_sql('Education', SCHOOLS, 'o_orderkey')}),
  k as (select category, case when demographic in ('19-21', '22-24') then '18-24' when demographic = '65-99' then '65+'
                              else demographic end as demographic, count(*)::double as workforce from p group by 1, 2),
  workforce as (
    select * from k where demographic <> '14-18'
    union all select category, 'Total', sum(workforce) from k group by 1)"""


@query("job_workforce", f"with {WORKFORCE_SQL} select * from workforce")
def job_workforce(t: Tables):
    return workforce.workforce(workforce_tables(t), QUARTER)


# Continuing claims -----------------------------------------------------------------------------

CLAIM_LABELS = (
    "Male", "Female", "Nonbinary/Other", "Total, All Unduplicated Claimants", "Ethnicity", "Race",
    "  African American", "  American Indian", " Asian", "  Caucasian", "  Latino/Hispanic of any race",
    "Not Latino/Hispanic:", "  Pacific Islander", "  Two or More Races", "  Unknown", "Not Disclosed",
    "Total, All Unduplicated Claimants", "Later block",
)


def claim_tabs(t: Tables) -> DataFrame:
    """One tab per county: label rows at fixed places, one text column per week."""
    slot = F.col("o_orderkey") % len(CLAIM_LABELS)
    weeks = [
        F.count_if(F.year("o_orderdate") == y).cast("string").alias(f"Week.{i}.ending.March.{7 + i},.{y}")
        for i, y in enumerate(t.years())
    ]
    rows = t.orders.groupBy((F.col("o_custkey") % 4).alias("c"), (slot + 1).alias("pos")).agg(*weeks)
    return rows.select(
        pick(F.col("c"), rules.COUNTIES).alias("county"), "pos", pick(F.col("pos") - 1, CLAIM_LABELS).alias("Industry"),
        F.lit("").alias("Demographic"), *[F.col(f"`{c}`") for c in rows.columns if c.startswith("Week")],
    )


CLAIMS_SQL = f"""
  w as (select {sql_list(CLAIM_LABELS)}[(o_orderkey % 18 + 1)::int] as raw, (o_orderkey % 18 + 1)::int as pos,
               make_date(year(o_orderdate), 3, (7 + year(o_orderdate) - (select min(year(o_orderdate)) from orders))::int) as date
        from orders),
  d as (select distinct date from w),
  labels as (select distinct (o_orderkey % 18 + 1)::int as pos, {sql_list(CLAIM_LABELS)}[(o_orderkey % 18 + 1)::int] as raw from orders),
  g as (select pos, raw, date, (select count(*) from w where w.pos = labels.pos and w.date = d.date)::double as estimate
        from labels, d),
  r as (select case trim(raw) when 'African American' then 'Black or African American Alone'
                 when 'American Indian' then 'American Indian or Alaska Native Alone' when 'Asian' then 'Asian Alone'
                 when 'Caucasian' then 'White Alone' when 'Latino/Hispanic of any race' then 'Hispanic or Latino'
                 when 'Pacific Islander' then 'Native Hawaiian or Other Pacific Islander Alone'
                 when 'Two or More Races' then 'Two or More Race Groups' else trim(raw) end as demographic, pos, date, estimate
        from g),
  claims as (select 'Race' as category, demographic, date, estimate from r where pos in (7, 8, 9, 10, 11, 13, 14)
             union all select 'Gender', demographic, date, estimate from r where pos in (1, 2))"""


@query(
    "job_claim_share",
    f"""with {WORKFORCE_SQL}, {CLAIMS_SQL}
       select c.category, c.demographic, c.date, c.estimate, w.workforce, c.estimate / nullif(w.workforce, 0) as share,
              year(c.date)::varchar as year
       from claims c left join workforce w on c.category = w.category and c.demographic = w.demographic""",
)
def job_claim_share(t: Tables):
    tables, tabs = workforce_tables(t), claim_tabs(t)
    race = claims.claim_share(
        claims.claims_by_race(tabs), workforce.by_race(tables["not_hispanic"], tables["hispanic"], QUARTER)
    )
    gender = claims.claim_share(claims.claims_by_gender(tabs), workforce.by_gender(tables["gender"], QUARTER))
    return stack(race.withColumn("category", F.lit("Race")), gender.withColumn("category", F.lit("Gender")))


# Initial claims --------------------------------------------------------------------------------

INITIAL_LABELS = {
    "Gender": ("Total, All Unduplicated Claimants", "Male", "Female", "Other", "Note"),
    "Race": (
        "Total, All Unduplicated Claimants", "Ethnicity", " African American", " American Indian", " Asian",
        " Caucasian", " Latino/Hispanic of any race", " Pacific Islander", " Two or More Races", "Unknown",
    ),
    "Age": ("Total, All Unduplicated Claimants", "<24", "18-24", "25-34", "35-44", "45-54", "55-64", "65+", "<18", "Note"),
    "Education": ("Total, All Unduplicated Claimants", *rules.EDUCATION_CLASSES, "Note"),
}
INITIAL_HEADS = {
    "Gender": "Gender.of.Claimant", "Race": "Race/Ethnicity.of.Claimant", "Age": "Age.of.Claimant",
    "Education": "Formal.Education.of.Claimant",
}


def initial_tab(t: Tables, category: str) -> DataFrame:
    labels = INITIAL_LABELS[category]
    counts = [
        F.count_if(F.col("o_custkey") % 5 == i).alias(f"{county}.County") for i, county in enumerate(rules.COUNTIES)
    ]
    rows = t.orders.groupBy((F.col("o_orderkey") % len(labels) + 1).alias("pos")).agg(*counts)
    return rows.select(
        F.lit(category).alias("file"), "pos", pick(F.col("pos") - 1, labels).alias(INITIAL_HEADS[category]),
        *[F.col(f"`{c}.County`") for c in rules.COUNTIES], F.lit(0).alias("Adams.County"),
    )


def _initial_sql(category: str, first: int, last: int) -> str:
    n = len(INITIAL_LABELS[category])
    return f"""select '{category}' as category, trim({sql_list(INITIAL_LABELS[category])}[(o_orderkey % {n} + 1)::int]) as raw,
                      count(*) filter (o_custkey % 5 <> 4)::double as n
               from orders where o_orderkey % {n} + 1 between {first} and {last} group by 1, 2"""


EDUCATION_SQL = "case raw " + " ".join(
    "when '{}' then '{}'".format(k.replace("'", "''"), v.replace("'", "''")) for k, v in rules.EDUCATION_CLASSES.items()
) + " end"

RACE_SQL = "case raw " + " ".join(f"when '{k}' then '{v}'" for k, v in rules.RACE_STEPS) + " else raw end"


def wrap_sql(c: str, width: int) -> str:
    return f"""list_reduce(string_split({c}, ' '), lambda acc, w: case
      when length(string_split(acc, chr(10))[-1]) + 1 + length(w) <= {width} then acc || ' ' || w else acc || chr(10) || w end)"""


@query(
    "job_initial_claims",
    f"""with {WORKFORCE_SQL},
       i as ({_initial_sql('Gender', 1, 3)} union all {_initial_sql('Race', 3, 9)}
             union all {_initial_sql('Age', 2, 9)} union all {_initial_sql('Education', 2, 11)}),
       n as (select category, case category when 'Race' then {RACE_SQL} when 'Education' then {EDUCATION_SQL} else raw end as demographic,
                    sum(n) as initial_claims
             from i where raw not in ('Total, All Unduplicated Claimants', '<18', '<24') group by 1, 2)
       select n.category, {wrap_sql('n.demographic', 10)} as demographic, n.initial_claims, w.workforce,
              n.initial_claims / nullif(w.workforce, 0) as share
       from n left join workforce w on n.demographic = w.demographic and w.demographic <> 'Total'""",
)
def job_initial_claims(t: Tables):
    tabs = {category: initial_tab(t, category) for category in INITIAL_LABELS}
    return claims.initial_claims(tabs, workforce.workforce(workforce_tables(t), QUARTER))


@query(
    "job_claim_titles",
    f"""with {WORKFORCE_SQL},
       i as ({_initial_sql('Gender', 1, 3)} union all {_initial_sql('Race', 3, 9)}
             union all {_initial_sql('Age', 2, 9)} union all {_initial_sql('Education', 2, 11)}),
       n as (select category, case category when 'Race' then {RACE_SQL} when 'Education' then {EDUCATION_SQL} else raw end as demographic,
                    sum(n) as initial_claims
             from i where raw not in ('Total, All Unduplicated Claimants', '<18', '<24') group by 1, 2)
       select category, demographic, initial_claims,
              replace(replace({wrap_sql('demographic', 10)}, 'Alone', ''), 'Latino', 'Latinx') as demographic_titles
       from n where demographic <> 'Under age 24'""",
)
def job_claim_titles(t: Tables):
    """Initial claims with a short title next to each label."""
    tabs = {category: initial_tab(t, category) for category in INITIAL_LABELS}
    rows = claims.initial_claims_raw(tabs, workforce.workforce(workforce_tables(t), QUARTER))
    return claims.with_titles(rows).select("category", "demographic", "initial_claims", "demographic_titles")


# Population ------------------------------------------------------------------------------------

COUNTY_OF_REGION = (*rules.COUNTIES, "Skagit")


def pop_years(t: Tables) -> range:
    years = t.years()
    return range(years.start + 20, years.stop + 20)


def place_counts(t: Tables, *keys: Column) -> DataFrame:
    """Orders by place attributes and year, the years moved to 2015-2021."""
    rows = placed_counts(t, (F.year("o_orderdate") + 20).alias("year"), *keys)
    key = F.col("n_nationkey")
    part = F.when(key % 2 == 0, " (part)").otherwise("")
    return rows.select(
        F.least(F.floor(key / 6) + 1, F.lit(4)).cast("string").alias("Filter"), pick(F.col("n_regionkey"), COUNTY_OF_REGION).alias("County"),
        F.concat(F.lit("Place "), key % 12, part).alias("Jurisdiction"), "year", "n",
        *[c for c in rows.columns if c not in ("n_nationkey", "n_regionkey", "year", "n")],
    )


def population_table(t: Tables) -> DataFrame:
    """One text column per year; ``.`` stands for a missing number."""
    head = F.concat(F.col("year"), F.lit(".Population.Estimate"))
    heads = [f"{y}.Population.Estimate" for y in pop_years(t)]
    rows = place_counts(t).withColumn("head", head)
    wide = rows.groupBy("Filter", "County", "Jurisdiction").pivot("head", heads).agg(F.sum("n"))
    cells = []
    for h in heads:
        v = F.col(f"`{h}`")
        cells.append(F.when(v.isNull() | (v % 11 == 0), ".").otherwise(v.cast("string")).alias(h))
    return wide.select(F.lit(1).alias("Line"), "Filter", "County", "Jurisdiction", *cells)


PLACE_SQL = f"""
  pc as (select least(c_nationkey // 6 + 1, 4)::int as level, {sql_list(COUNTY_OF_REGION)}[n_regionkey + 1] as county,
                'Place ' || (c_nationkey % 12) as place, c_nationkey % 2 = 0 as part, (year(o_orderdate) + 20)::int as year,
                o_orderstatus, count(*) as n
         from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey group by all)"""

POPULATION_SQL = f"""{PLACE_SQL},
  px as (select c.level, c.county, c.place, c.part, y::int as year,
                (select sum(n) from pc where pc.level = c.level and pc.county = c.county and pc.place = c.place
                 and pc.part = c.part and pc.year = y) as n
         from (select distinct level, county, place, part from pc) c cross join (select unnest({YEARS_SQL}) + 20 as y)),
  pv as (select level, place, year, case when n is null or n % 11 = 0 then null else n::double end as v
         from px where county <> 'Skagit'),
  pm as (select level, place, year, case when count(v) = count(*) then sum(v) end as estimate from pv group by 1, 2, 3),
  population as (
    select level, place, year, estimate, 'Total Population' as variable from pm
    union all
    select level, case level when 1 then 'Region' when 2 then 'Unincorporated Region Total' else 'Incorporated Region Total' end,
           year, case when count(estimate) = count(*) then sum(estimate) end, 'Total Population' from pm where level <= 3 group by 1, 3)"""


@query("job_population", f"with {POPULATION_SQL} select * from population")
def job_population(t: Tables):
    return population.population(population_table(t))


def component_tables(t: Tables) -> dict[str, DataFrame]:
    """Three tables with columns ``<component>.<from>-<to>``; the last one carries a footnote mark."""
    status = {"Natural.Increase": ["F"], "Residual.Net.Migration": ["O"], "Annual.Change.in.Total.Population": ["F", "O"]}
    rows = place_counts(t, F.col("o_orderstatus"))
    out = {}
    for component, kinds in status.items():
        years = pop_years(t)
        heads = {y: f"{component}.{y - 1}-{y}" + ("1" if y == years[-1] else "") for y in years}
        wide = rows.filter(F.col("o_orderstatus").isin(*kinds)).groupBy("County", "Jurisdiction").pivot(
            "year", list(years)
        ).agg(F.sum("n"))
        out[component] = wide.select(
            F.lit("").alias("Spacer"), "County", "Jurisdiction",
            *[F.coalesce(F.col(f"`{y}`"), F.lit(0)).cast("string").alias(h) for y, h in heads.items()],
        )
    return out


CHANGE_SQL = f"""{PLACE_SQL},
  cn(variable, s) as (values ('Natural Increase', 'F'), ('Migration', 'O'), ('Total Change', 'F'), ('Total Change', 'O')),
  cp as (select distinct variable, county, place, part from pc join cn on o_orderstatus = s where county <> 'Skagit'),
  cg as (select variable, county, place, part, y::int as year,
                coalesce((select sum(n) from pc join cn on o_orderstatus = s
                          where cn.variable = cp.variable and pc.county = cp.county and pc.place = cp.place and pc.part = cp.part
                            and pc.year = y), 0)::double as estimate
         from cp cross join (select unnest({YEARS_SQL}) + 20 as y)),
  change as (
    select 4 as level, place, year, estimate, variable from cg
    union all select 5, 'Region', year, sum(estimate), variable from cg group by year, variable)"""


@query("job_components", f"with {CHANGE_SQL} select * from change")
def job_components(t: Tables):
    return population.components_of_change(component_tables(t))


@query(
    "job_components_region",
    f"""with {CHANGE_SQL} select make_date(year, 4, 1) as day, place, variable, estimate from change
       where place = 'Region' and variable <> 'Total Change' and year >= 2017""",
)
def job_components_region(t: Tables):
    return population.region_components(population.components_of_change(component_tables(t)), 2017)


UNIT_OF = {"F": "One Unit", "O": "Two or More", "P": "Mobile Home and Special"}


def housing_table(t: Tables) -> DataFrame:
    """One text column per year and type; three spellings of the head, bad text for a missing number."""
    kind = F.lit(None).cast("string")
    for status, name in UNIT_OF.items():
        kind = F.when(F.col("o_orderstatus") == status, name).otherwise(kind)
    rows = place_counts(t, F.col("o_orderstatus")).withColumn("kind", kind)
    rows = merge_buckets(
        rows.select("Filter", "County", "Jurisdiction", "year", "kind", "n"), "kind",
        ["Filter", "County", "Jurisdiction", "year"], ["n"], {"Total": list(UNIT_OF.values())},
    )
    spelling = {2020: "Census.Count.of", 2016: "Census-Based.Estimate.of"}
    heads = [
        f"{y}.{spelling.get(y, 'Postcensal.Estimate.of')}.{k.replace(' ', '.')}.Housing.Units"
        for y in pop_years(t) for k in ("Total", *UNIT_OF.values())
    ]
    middle = F.when(F.col("year") == 2020, "Census.Count.of").when(F.col("year") == 2016, "Census-Based.Estimate.of").otherwise(
        "Postcensal.Estimate.of"
    )
    head = F.concat_ws(".", "year", middle, F.replace("kind", F.lit(" "), F.lit(".")), F.lit("Housing.Units"))
    wide = rows.withColumn("head", head).groupBy("Filter", "County", "Jurisdiction").pivot("head", heads).agg(F.sum("n"))
    return wide.select(
        F.lit(1).alias("Line"), "Filter", "County", "Jurisdiction",
        *[F.coalesce(F.col(f"`{h}`").cast("string"), F.lit("n/a")).alias(h) for h in heads],
    )


HOUSING_SQL = f"""{PLACE_SQL},
  hk(variable, s) as (values ('One Unit Housing Units', 'F'), ('Two or More Housing Units', 'O'),
                             ('Mobile Home and Special Housing Units', 'P'), ('Total Housing Units', 'F'),
                             ('Total Housing Units', 'O'), ('Total Housing Units', 'P')),
  hp as (select distinct level, place, variable, y::int as year
         from (select distinct level, place, county from pc where county <> 'Skagit'), (select distinct variable from hk),
              (select unnest({YEARS_SQL}) + 20 as y)),
  hu as (select level, place, year, variable,
                coalesce((select sum(n) from pc join hk on o_orderstatus = s where hk.variable = hp.variable and pc.level = hp.level
                          and pc.place = hp.place and pc.year = hp.year and pc.county <> 'Skagit'), 0)::double as estimate
         from hp),
  housing as (
    select * from hu union all
    select 5, 'Region', year, variable, sum(estimate) from hu where level = 1 group by year, variable)"""


@query("job_housing_units", f"with {HOUSING_SQL} select * from housing")
def job_housing_units(t: Tables):
    return population.housing_units(housing_table(t))


@query(
    "job_housing_change",
    f"""with {HOUSING_SQL},
       k as (select case variable when 'One Unit Housing Units' then 'Single-Family' when 'Two or More Housing Units' then 'Multi-Family'
                    else 'Mobile-Home' end as unit_type, year, estimate,
                    estimate - lag(estimate) over (partition by variable order by year) as delta,
                    list_position(['One Unit Housing Units', 'Two or More Housing Units'], variable) as p
             from housing where place = 'Region' and variable <> 'Total Housing Units' and year >= 2016)
       select unit_type, year, estimate, delta, case when coalesce(p, 0) = 0 then 3 else p end::int as place_in_order from k where year > 2016""",
)
def job_housing_change(t: Tables):
    return population.housing_change(population.housing_units(housing_table(t)), 2016)


def postcensal_population_table(t: Tables) -> DataFrame:
    """Yearly series whose heads hold line breaks; full-count years come twice."""
    rows = place_counts(t)
    years = list(pop_years(t))
    wide = rows.groupBy("Filter", "County", "Jurisdiction").pivot("year", years).agg(F.sum("n"))

    def text(y: int) -> Column:
        return F.coalesce(F.col(f"`{y}`").cast("string"), F.lit("."))

    cells = [text(y).alias(f"{y}\r\n Postcensal Estimate of Total Population") for y in years]
    cells += [text(2020).alias("2020\r\n Census Count of Total Population"), F.lit("x").alias("Note.1")]
    return wide.select(F.lit(1).alias("Line"), "Filter", "County", "Jurisdiction", *cells)


POSTCENSAL_SQL = f"""{PLACE_SQL},
  pr as (select level, county, place || case when part then ' (part)' else '' end as place, year, sum(n)::double as estimate
         from pc where county <> 'Skagit' group by 1, 2, 3, 4),
  rg as (select level, 'Region' as county, case level when 1 then 'Region' when 2 then 'Unincorporated Region' else 'Incorporated Region' end as place,
                year, sum(estimate) as estimate from pr where level <= 3 group by 1, 4)
  select level, county, place, year, estimate, 'Population' as variable, 'Postcensal Estimates' as data_type from pr
  union all select level, county, place, year, estimate, 'Population', 'Postcensal Estimates' from rg"""


@query("job_postcensal_population", f"with {POSTCENSAL_SQL}")
def job_postcensal_population(t: Tables):
    return population.postcensal_population(postcensal_population_table(t))


def postcensal_housing_table(t: Tables) -> DataFrame:
    kind = F.lit(None).cast("string")
    for status, name in UNIT_OF.items():
        kind = F.when(F.col("o_orderstatus") == status, name).otherwise(kind)
    head = F.concat(F.col("year"), F.lit("\r\n Postcensal Estimate of "), kind, F.lit(" Housing Units"))
    heads = [f"{y}\r\n Postcensal Estimate of {k} Housing Units" for y in pop_years(t) for k in UNIT_OF.values()]
    rows = place_counts(t, F.col("o_orderstatus")).withColumn("head", head)
    wide = rows.groupBy("Filter", "County", "Jurisdiction").pivot("head", heads).agg(F.sum("n"))
    return wide.select(
        F.lit(1).alias("Line"), "Filter", "County", "Jurisdiction",
        *[F.coalesce(F.col(f"`{h}`").cast("string"), F.lit(".")).alias(h) for h in heads],
    )


@query(
    "job_postcensal_housing",
    f"""with {PLACE_SQL},
  pr as (select level, county, place || case when part then ' (part)' else '' end as place, year,
                case o_orderstatus when 'F' then 'Single-Family Units' when 'O' then 'Multi-Family Units' else 'Mobile Home Units' end as variable,
                sum(n)::double as estimate
         from pc where county <> 'Skagit' group by all),
  rg as (select level, 'Region' as county, case level when 1 then 'Region' when 2 then 'Unincorporated Region' else 'Incorporated Region' end as place,
                year, variable, sum(estimate) as estimate from pr where level <= 3 group by 1, 4, 5)
  select *, 'Postcensal Estimates' as data_type from (select level, county, place, year, variable, estimate from pr
                                                      union all select level, county, place, year, variable, estimate from rg)""",
)
def job_postcensal_housing(t: Tables):
    return population.postcensal_housing(postcensal_housing_table(t))


# Growth by place -------------------------------------------------------------------------------

CLASSES = ("Metro", "Core", "HCT", "CitiesTowns")


def dims_table(t: Tables) -> DataFrame:
    """Jurisdiction dimension: short class names, county codes, repeated rows."""
    key = F.col("n_nationkey") % 12
    return t.nation.select(
        F.concat(F.lit("Place "), key).alias("juris_name"), pick(key % 4, CLASSES).alias("regional_geography"),
        F.lit("Yes").alias("airport_affected"), pick(key % 4, tuple(rules.COUNTY_BY_FIPS)).alias("county_fips"),
    )


def growth(t: Tables) -> DataFrame:
    dims = population.jurisdictions(dims_table(t))
    people = population.population(population_table(t), labels=rules.REGION_LEVELS_SHORT)
    return population.place_growth(people, dims, 2021)


GROWTH_SQL = f"""{POPULATION_SQL},
  pd as (select level, place, year, estimate, case when year = 2021 then
                estimate - lag(estimate) over (partition by level, place order by year) end as delta from population),
  growth as (select pd.*, k % 4 as c,
                    ['Metropolitan Cities', 'Core Cities', 'High Capacity Transit Community', 'Cities & Towns'][(k % 4 + 1)::int] as regional_geography,
                    ['King County', 'Kitsap County', 'Pierce County', 'Snohomish County'][(k % 4 + 1)::int] as county_name
             from pd left join (select unnest(range(0, 12)) as k) on place = 'Place ' || k)"""


@query(
    "job_place_growth",
    f"""with {GROWTH_SQL}
       select regional_geography, sum(delta) as delta, sum(round_even(delta, -1)) as delta_rounded, (min(c) + 1)::int as place_in_order
       from growth where year = 2021 and regional_geography is not null group by 1""",
)
def job_place_growth(t: Tables):
    return population.growth_by_class(growth(t), 2021)


@query(
    "job_place_top",
    f"""with {GROWTH_SQL},
       r as (select *, row_number() over (partition by county_name order by delta desc nulls last, place)::int as rank
             from growth where year = 2021 and level = 4 and county_name is not null)
       select level, place, estimate, delta, county_name, rank from r where rank <= 2""",
)
def job_place_top(t: Tables):
    top = population.fastest_places_by_county(growth(t), 2021, n=2)
    return top.select("level", "place", "estimate", "delta", "county_name", "rank")


@query(
    "job_place_table",
    f"""with {GROWTH_SQL},
       w as (select place, county_name, max(estimate) filter (year = 2020) as a, max(estimate) filter (year = 2021) as b,
                    max(delta) filter (year = 2021) as d from growth where level = 4 group by 1, 2)
       select place, county_name, round_even(a, -1) as first, round_even(b, -1) as last, round_even(d, -1) as delta
       from w where a is not null""",
)
def job_place_table(t: Tables):
    return population.place_table(growth(t), 2020, 2021)


@query(
    "job_growth_report",
    f"""with {GROWTH_SQL},
       y as (select * from growth where year = 2021),
       top as (select *, row_number() over (order by delta desc nulls last, place) as rank from y where level = 4),
       by_county as (select *, row_number() over (partition by county_name order by delta desc nulls last, place) as rank
                     from y where level = 4 and county_name is not null)
       select 'county-growth' as sheet, replace(place, ' Total', '') as place, delta from y where level = 1
       union all select 'incorporated-growth', replace(place, ' Total', ''), delta from y
                 where place in ('Unincorporated Region Total', 'Incorporated Region Total')
       union all select 'regional-geography-growth', regional_geography, sum(delta) from y where regional_geography is not null group by 2
       union all select 'region-fastest-growing', place, delta from top where rank <= 10
       union all select lower(split_part(county_name, ' ', 1)) || '-fastest-growing', place, delta from by_county where rank <= 10
       union all select 'city-data', place, round_even(max(delta) filter (year = 2021), -1) from growth
                 where level = 4 group by place, county_name having max(estimate) filter (year = 2020) is not null""",
)
def job_growth_report(t: Tables):
    """The nine tables of the population report, written as one report and read back by its manifest."""
    root = scratch_folder(t.spark, "growth-report")
    write_report(population.growth_report(growth(t), 2021), root)
    return stack(*[
        df.select(F.lit(name).alias("sheet"), F.col("place" if "place" in df.columns else "regional_geography").alias("place"), "delta")
        for name, df in read_report(t.spark, root).items()
    ])


@query(
    "job_place_counts",
    f"""with {GROWTH_SQL},
       top as (select * from growth where year = 2021 and level = 4 order by delta desc nulls last, place limit 5)
       select county_name, count(*) as places from top group by 1""",
)
def job_place_counts(t: Tables):
    return population.counts_by_county(population.fastest_places(growth(t), 2021, n=5))


@query(
    "job_place_years",
    f"""with {POPULATION_SQL}
       select level, place, year::varchar as year, estimate, variable, list_position(['Place 7', 'Place 1', 'Region'], place)::int as place_in_order
       from population where place in ('Place 7', 'Place 1', 'Region') and year in (2016, 2021)""",
)
def job_place_years(t: Tables):
    people = population.population(population_table(t)).select("level", "place", "year", "estimate", "variable")
    return population.place_years(people, "Total Population", ["Place 7", "Place 1", "Region"], [2016, 2021])


def cities_table(t: Tables) -> DataFrame:
    key = F.col("n_nationkey") % 12
    return t.nation.select(
        F.concat(F.lit("Place "), key).alias("city_name"), pick(key % 4, rules.COUNTIES).alias("cnty_name"),
        F.nullif(pick(key % 4, CLASSES), F.lit("HCT")).alias("class_desc"),
    )


@query(
    "job_class_change",
    f"""with {POPULATION_SQL},
       c as (select year, estimate,
                    case when place = 'Region' or place like '%Region%' then 'Region'
                         else nullif(['Metro', 'Core', 'HCT', 'CitiesTowns'][(k % 4 + 1)::int], 'HCT') end as class_desc
             from population left join (select unnest(range(0, 12)) as k) on place = 'Place ' || k),
       g as (select class_desc, sum(estimate) filter (year = 2015) as first, sum(estimate) filter (year = 2020) as last
             from c where class_desc is not null and class_desc <> 'Region' and year in (2015, 2020) group by 1)
       select class_desc, first, last, last - first as delta,
              list_position(['Metro', 'Core', 'HCT', 'CitiesTowns', 'Unincorporated'], class_desc)::int as place_in_order from g""",
)
def job_class_change(t: Tables):
    people = population.population(population_table(t))
    classes = population.place_classes(cities_table(t))
    return population.class_change(people, classes, "Total Population", 2015, 2020)
