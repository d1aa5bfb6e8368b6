"""Property tests: operators vs brute-force Python on random small inputs (NULLs, blanks, duplicates)."""

import datetime as dt
from collections import Counter, defaultdict

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from strata.operators import clean as C
from strata.operators import metrics as M
from strata.operators import profile as P

SCHEMA = "k int, d date, a string, b int"
ROW = st.tuples(
    st.one_of(st.none(), st.integers(0, 4)),
    st.one_of(st.none(), st.dates(dt.date(2020, 1, 1), dt.date(2020, 1, 4))),
    st.sampled_from([None, "", " x", "x", "y ", "y"]),
    st.one_of(st.none(), st.integers(0, 2)),
)
TABLE = st.lists(ROW, min_size=0, max_size=25)
SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def _asc_nulls_last(v):
    return (v is None, v if v is not None else 0)


def brute_dedupe(data):
    groups = defaultdict(list)
    for r in data:
        if r[0] is not None:
            groups[r[0]].append(r)
    out = []
    for rs in groups.values():
        def key(r):
            d = r[1]
            date_key = (d is None, -(d.toordinal()) if d is not None else 0)   # DESC NULLS LAST
            nulls = sum(v is None for v in r[1:])
            return (date_key, nulls, _asc_nulls_last(r[2]), _asc_nulls_last(r[3]))
        out.append(min(rs, key=key))
    return sorted(out, key=repr)


@SETTINGS
@given(TABLE)
def test_dedupe_matches_brute_force(spark, data):
    df = spark.createDataFrame(data, SCHEMA).repartition(3)
    got = sorted((tuple(r) for r in C.dedupe_latest(df, ["k"], "d").collect()), key=repr)
    assert got == brute_dedupe(data)


@SETTINGS
@given(TABLE)
def test_profile_and_duplicate_checks_match_brute_force(spark, data):
    df = spark.createDataFrame(data, SCHEMA)
    prof = P.profile(df).collect()[0].asDict()
    assert prof["total_rows"] == len(data)
    for i, c in enumerate("kdab"):
        assert prof[f"{c}_nulls"] == sum(r[i] is None for r in data)
    assert prof["a_empty"] == sum(r[2] == "" for r in data)
    assert prof["a_has_whitespace"] == sum(r[2] is not None and r[2] != r[2].strip(" ") for r in data)
    dup = dict(tuple(r) for r in P.duplicate_check(df, {"k": "k", "ka": ["k", "a"]}).collect())
    ck = Counter(r[0] for r in data if r[0] is not None)
    cka = Counter((r[0], r[2]) for r in data if r[0] is not None and r[2] is not None)
    assert dup == {"k": sum(v > 1 for v in ck.values()), "ka": sum(v > 1 for v in cka.values())}


@SETTINGS
@given(TABLE)
def test_distribution_and_column_diff_match_brute_force(spark, data):
    df = spark.createDataFrame(data, SCHEMA)
    dist = Counter({(r.column_name, r.value): r["count"] for r in P.category_distribution(df, ["a", "b"]).collect()})
    want = Counter(("a", r[2]) for r in data) + Counter(("b", None if r[3] is None else str(r[3])) for r in data)
    assert dist == want
    groups = defaultdict(list)
    for r in data:
        if r[0] is not None:
            groups[r[0]].append(r)
    multi = [rs for rs in groups.values() if len(rs) > 1]
    diff = dict(tuple(r) for r in P.duplicate_column_diff(df, "k").collect())
    for i, c in ((1, "d"), (2, "a"), (3, "b")):
        assert diff[c] == sum(len({r[i] for r in rs}) > 1 for rs in multi)


@SETTINGS
@given(TABLE, st.lists(st.sampled_from(["", " x", "x", "y"]), max_size=2, unique=True),
       st.lists(st.integers(0, 2), max_size=2, unique=True))
def test_filters_match_brute_force(spark, data, sel_a, sel_b):
    df = spark.createDataFrame(data, SCHEMA)
    sel = {"a": sel_a, "b": sel_b}

    def keep(r, skip=None):
        return all(not v or (r[i] is not None and r[i] in v) for c, i, v in (("a", 2, sel_a), ("b", 3, sel_b)) if c != skip)
    assert M.filtered(df, sel).count() == sum(keep(r) for r in data)
    fv = {r.a: r.a_associativity for r in M.filter_values(df, "a", sel).collect()}
    want = defaultdict(int)
    for r in data:
        want[r[2]] += keep(r, skip="a")
    assert fv == dict(want)


KEYS = st.lists(st.one_of(st.none(), st.text(alphabet="AB-é0 ", max_size=8)), min_size=1, max_size=20)


@SETTINGS
@given(KEYS)
def test_derived_and_segment_keys_match_python(spark, keys):
    from strata.functions.expr import derived_key, segment_key

    df = spark.createDataFrame([(k,) for k in keys], "k string")
    got = [tuple(r) for r in df.select(derived_key("NASA", "k", 2).alias("a"), derived_key("AW-", "k", 3).alias("b"),
                                       segment_key("k").alias("c")).collect()]

    def seg(k):
        if k is None:
            return None
        parts = k.split("-")
        return None if len(parts) < 2 else parts[0] + "_" + parts[1]

    want = [(None if k is None else "NASA" + k[1:], None if k is None else "AW-" + k[2:], seg(k)) for k in keys]
    assert got == want


CUST_KEY = st.one_of(st.none(), st.sampled_from(["AW1", "AW2", "AX1", "A", "", "AW-9"]))
GENDER = st.sampled_from([None, "", " ", "M", "F", "Male ", "x"])
SILVER_GENDER = st.sampled_from(["Unknown", "Male", "Female", "", "n/a"])
COUNTRY = st.sampled_from([None, "", " ", "US", "USA", "DE", " France ", "Spain"])


@SETTINGS
@given(st.lists(st.tuples(CUST_KEY, SILVER_GENDER), min_size=1, max_size=12),
       st.lists(st.tuples(st.sampled_from(["NASAW1", "NASAW2 ", "NASAX1", "NASA", "NAS", None]), GENDER), max_size=6),
       st.lists(st.tuples(st.sampled_from(["AW-1", " AW-2", "AW-", "AW-9", "X", None]), COUNTRY), max_size=6))
def test_gold_customer_matches_brute_force(spark, cust, erp_cust, erp_loc):
    import datetime as _dt

    from strata.plans import gold as G

    D0 = _dt.date(2024, 1, 1)
    silver = spark.createDataFrame(
        [(i, k, "f", "l", "Single", g, D0) for i, (k, g) in enumerate(cust)],
        "customer_id int, customer_key string, first_name string, last_name string, marital_status string, "
        "gender string, created_date date")
    ec = spark.createDataFrame([(c, D0, g) for c, g in erp_cust], "CID string, BDATE date, GEN string")
    el = spark.createDataFrame(erp_loc, "CID string, CNTRY string")
    got = sorted((tuple(r) for r in G.gold_customer(silver, ec, el).select("customer_id", "gender", "birth_date",
                                                                             "country").collect()), key=repr)

    def strip(v):
        return None if v is None else v.strip(" ")

    def country(c):
        if c in ("USA", "US"):
            return "United States"
        if c == "DE":
            return "Germany"
        if c is None or c.strip(" ") == "":
            return "Unknown"
        return c.strip(" ")

    def erp_gender(g):
        if g == "M":
            return "Male"
        if g == "F":
            return "Female"
        if g is None or g.strip(" ") == "":
            return None
        return g.strip(" ")

    want = []
    for i, (k, g) in enumerate(cust):
        ck = None if k is None else "NASA" + k[1:]
        lk = None if k is None else "AW-" + k[2:]
        cm = [(D0, strip(gg)) for c, gg in erp_cust if ck is not None and strip(c) == ck] or [(None, None)]
        lm = [strip(cc) for c, cc in erp_loc if lk is not None and strip(c) == lk] or [None]
        for bdate, eg in cm:
            for cc in lm:
                clean = erp_gender(eg)
                gender = clean if (g == "Unknown" and clean is not None) else g
                want.append((i, gender, bdate, country(cc)))
    assert got == sorted(want, key=repr)


PKEY = st.sampled_from(["AB-C-1", "AB-C-2", "AB-D-3", "NOHYPHEN", "AB-", "-C-9", None])


@SETTINGS
@given(st.lists(st.tuples(st.integers(1, 6), PKEY, st.one_of(st.none(), st.integers(0, 9))), min_size=1, max_size=10,
                unique_by=lambda t: t[0]),
       st.lists(st.tuples(st.integers(1, 8), st.sampled_from(["m1", "m2"]), st.integers(0, 9)), max_size=8,
                unique_by=lambda t: t[0]),
       st.lists(st.tuples(st.sampled_from(["AB_C", " AB_D", "AB_", "_C", "ZZ_Z"]), st.sampled_from(["cat1", "cat2 "])),
                max_size=5))
def test_gold_sales_matches_brute_force(spark, sales, products, cats):
    import datetime as _dt

    from strata.plans import gold as G

    D0 = _dt.date(2020, 1, 1)
    schema = ("product_id int, product_key string, product_name string, cost int, product_line string, "
              "start_date date, end_date date")
    sls = spark.createDataFrame([(i, k, "s", c, "Road", D0, None) for i, k, c in sales], schema)
    prd = spark.createDataFrame([(i, "k", n, c, "Touring", D0, None) for i, n, c in products], schema)
    cat = spark.createDataFrame([(c, n, "sub", "Yes") for c, n in cats], "ID string, CAT string, SUBCAT string, "
                                                                          "MAINTENANCE string")
    got = sorted((tuple(r) for r in G.gold_sales(sls, prd, cat).select(
        "product_id", "cost", "category", "master_product_name", "master_cost").collect()), key=repr)

    def seg(k):
        if k is None:
            return None
        p = k.split("-")
        return None if len(p) < 2 else p[0] + "_" + p[1]

    master = {i: (n, c) for i, n, c in products}
    want = []
    for i, k, c in sales:
        mn, mc = master.get(i, (None, None))
        cid = seg(k)
        matches = [n.strip(" ") for cc, n in cats if cid is not None and cc.strip(" ") == cid] or [None]
        for m in matches:
            want.append((i, c, m, mn, mc))
    assert got == sorted(want, key=repr)


CROW = st.tuples(
    st.one_of(st.none(), st.integers(0, 3)),
    st.sampled_from([None, "AW1", " AW1", "AW2 "]),
    st.sampled_from([None, "", " a", "a", "b"]),
    st.sampled_from([None, "x", "y "]),
    st.sampled_from([None, "M", " M", "S", "X", ""]),
    st.sampled_from([None, "M", "F ", "F", "U"]),
    st.one_of(st.none(), st.dates(dt.date(2024, 1, 1), dt.date(2024, 1, 3))),
)


@SETTINGS
@given(st.lists(CROW, max_size=20))
def test_silver_customer_matches_brute_force(spark, data):
    from strata.plans.silver import silver_customer

    schema = ("cst_id int, cst_key string, cst_firstname string, cst_lastname string, cst_marital_status string, "
              "cst_gndr string, cst_create_date date")
    got = sorted((tuple(r) for r in silver_customer(spark.createDataFrame(data, schema).repartition(3)).collect()),
                 key=repr)

    def t(v):
        return None if v is None else v.strip(" ")

    trimmed = [(r[0], t(r[1]), t(r[2]), t(r[3]), t(r[4]), t(r[5]), r[6]) for r in data]
    groups = defaultdict(list)
    for r in trimmed:
        if r[0] is not None:
            groups[r[0]].append(r)

    def order(r):
        d = r[6]
        return ((d is None, -(d.toordinal()) if d is not None else 0), sum(v is None for v in r[1:]),
                *[_asc_nulls_last(v) for v in r[1:6]])

    want = []
    for rs in groups.values():
        r = min(rs, key=order)
        g = "Unknown" if r[5] is None else r[5]
        g = {"M": "Male", "F": "Female"}.get(g, g)
        m = {"M": "Married", "S": "Single"}.get(r[4], r[4])
        want.append((r[0], r[1], r[2], r[3], m, g, r[6]))
    assert got == sorted(want, key=repr)


def test_fixture_keys_do_not_collide_beyond_their_padded_width(spark):
    """Ids of nine and ten digits keep distinct keys, gold keeps the silver row count, planted sales ids meet no real id."""
    from strata.plans import gold, silver
    from strata.sources.fixtures import FIXTURES

    ids = [*range(100_000_000, 100_000_400), *range(2_147_483_000, 2_147_483_400)]
    customer = spark.createDataFrame([(i, f"name {i}", "SEG", i % 25) for i in ids], "c_custkey bigint, c_name string, c_mktsegment string, c_nationkey int")
    nation = spark.createDataFrame([(i, f"N{i}") for i in range(25)], "n_nationkey int, n_name string")
    cust = spark.sql(FIXTURES["fx_cust_info"][0], customer=customer)
    assert cust.select("cst_key").distinct().count() == len(ids)
    s = silver.silver_customer(cust)
    g = gold.gold_customer(s, spark.sql(FIXTURES["fx_erp_cust"][0], customer=customer), spark.sql(FIXTURES["fx_erp_loc"][0], customer=customer, nation=nation))
    assert g.count() == s.count()
    part = spark.createDataFrame([(i, f"p{i}", "STEEL", "Brand#11", 7, 10.0) for i in range(1, 300)] + [(i + 100_000, "p", "STEEL", "Brand#11", 7, 10.0) for i in range(1, 300)],
                                 "p_partkey bigint, p_name string, p_type string, p_brand string, p_size int, p_retailprice double")
    prd = spark.sql(FIXTURES["fx_prd_info"][0], part=part)
    sales = spark.sql(FIXTURES["fx_sales_details"][0], fx_prd_info=prd)
    real = {r[0] for r in prd.select("prd_id").collect()}
    assert sales.where("prd_nm LIKE '% x'").count() > 0 and not real & {r[0] for r in sales.where("prd_nm LIKE '% x'").select("prd_id").collect()}
