import pytest

from wardmill.session import local_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    return local_session(8, **{"spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared"))})


@pytest.fixture(scope="session")
def odd(spark):
    """Documents with nulls, empty and repeated rows, ties, a long text, and columns with the operators' names."""
    import random

    rnd = random.Random(7)
    word = [f"w{k}" for k in range(400)] + ["the", "é", "MIT", "License", "中文"]
    base = [" ".join(rnd.choice(word) for _ in range(60)) for _ in range(12)]
    lines = ["\n".join(" ".join(rnd.choice(word) for _ in range(6)) for _ in range(8)) for _ in range(4)]
    rows = [(k, t) for k, t in enumerate(base)]
    rows += [(100 + k, base[k]) for k in range(3)]  # copies
    rows += [(200 + k, " ".join(["changed"] + base[k].split()[1:])) for k in range(3)]  # near copies
    rows += [(300 + k, lines[k] + "\n\n" + lines[(k + 1) % 4]) for k in range(4)]
    rows += [(400, None), (401, ""), (402, " \n\t"), (403, "one"), (404, "123 456"), (405, "a " * 3000), (406, "x" * 70000)]
    rows += [(407, lines[0] + "\n" + lines[0]), (408, "cc, by! apache license"), (408, "cc, by! apache license")]
    rows += [(None, base[0]), (None, None), (-5, base[5] + " " + base[6])]
    data = [(d, t, "en" if (d or 0) % 2 else "fr", 1, "x", True) for d, t in rows]
    schema = "doc_id long, text string, lang string, row int, keys string, kept boolean"
    return spark.createDataFrame(data, schema).repartition(3)


@pytest.fixture(scope="session")
def nothing(odd):
    return odd.where("false")
