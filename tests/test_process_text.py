import pytest
from pyspark.sql import functions as F

from hostvane.functions import process_text as pt

X = F.col("x")


def process(**values):
    base = {"pid": 1, "name": "svc", "username": "u", "cpu_percent": 11.5, "memory_info": {"rss": 1000, "vms": 1500}}
    return base | values


def read(one, value, **options):
    text = value if isinstance(value, str) else str(value)
    return one(pt.parse_list(X, **options), "x string", text)


def test_empty_list_and_malformed(one):
    assert read(one, "[]") == []
    assert read(one, "[{'pid': ") is None
    assert one(pt.list_size(pt.parse_list(X)), "x string", "[{'pid': ") is None
    assert one(pt.list_size(pt.parse_list(X)), "x string", "[]") == 0


@pytest.mark.parametrize(
    "name",
    [
        "plain",
        "NoneSuch",
        "a None, True: False]",
        "it's",
        'say "hi"',
        "both ' and \"",
        "C:\\Users\\x\\None",
        "tab\tand\nline",
        "caf\xe9 \x07 bell",
        "trailing\\",
        "x'}, {'pid': None",
        "ends with N",
    ],
)
def test_values_survive(one, name):
    [record] = read(one, [process(name=name, username=None)])
    assert (record.name, record.username, record.memory_info.vms) == (name, None, 1500)


def test_several_records_and_words(one):
    records = read(one, [process(pid=i, username=None if i % 2 else "None") for i in range(5)])
    assert [r.username for r in records] == ["None", None, "None", None, "None"]


def test_booleans(one):
    schema = "array<struct<a:boolean,b:boolean,c:string>>"
    [record] = read(one, [{"a": True, "b": False, "c": "True"}], schema=schema)
    assert (record.a, record.b, record.c) == (True, False, "True")


def test_plain_replacement_changes_values_too(one):
    assert one(pt.literal_to_json(X, safe=False), "x string", "{'a': None, 'b': 'NoneSuch', 'c': True}") == (
        '{"a": null, "b": "nullSuch", "c": true}'
    )
    assert read(one, [process(name="it's")], safe=False) is None


def test_agent_record(one):
    text = (
        r"[{'pid': 77, 'name': 'pmem(rss=5)', 'num_threads': 4, 'username': 'LAB\\bruno', "
        r"'exe': 'D:\\Tools (old)\\vela.exe', 'cmdline': ['D:\\x y\\vela.exe', '--port=9090', 'f(x=1)', None], "
        "'memory_info': pmem(rss=410000000, vms=530000000, private=1), 'memory_percent': 1.25, 'status': 'sleeping', "
        "'cpu_times': pcputimes(user=2.5, system=0.75, children_user=0.0), 'cpu_percent': 0.0, "
        "'create_time': 1927000000.25}]"
    )
    [record] = one(pt.parse_agent_list(X), "x string", text)
    assert record.memory_info.asDict() == {"rss": 410000000, "vms": 530000000}
    assert record.cpu_times.asDict() == {"user": 2.5, "system": 0.75}
    assert record.cmdline == ["D:\\x y\\vela.exe", "--port=9090", "f(x=1)", None]
    assert (record.username, record.exe) == ("LAB\\bruno", "D:\\Tools (old)\\vela.exe")
    assert (record.name, record.pid, record.memory_percent) == ("pmem(rss=5)", 77, 1.25)


def test_long_lists_do_not_overflow(one):
    records = read(one, [process(pid=i, username=None, name="n'" * 50) for i in range(20_000)])
    assert len(records) == 20_000 and records[-1].pid == 19_999


def test_text_round_trip(one):
    schema = "array<struct<pid:bigint,name:string>>"
    column = pt.parse_list(pt.list_to_text(pt.parse_list(X, schema)), schema)
    assert [r.name for r in one(column, "x string", "[{'pid': 1, 'name': 'it\\'s None'}]")] == ["it's None"]


def test_lists_are_parsed_once(spark):
    """Exploding must not parse a second time for a filter the optimizer adds below it."""
    from hostvane.operators import processes

    frame = spark.range(3).select(F.concat(F.lit("[{'pid': "), F.col("id").cast("string"), F.lit("}]")).alias("x"))
    rows = processes.explode_list(frame.select(pt.parse_list(X).alias("p")), "p", [])
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1
