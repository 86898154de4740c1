import numpy as np
import pytest

DOC = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def documents(spark):
    """Rows -> a documents table; short rows are filled up with nulls."""
    def make(rows, schema=DOC):
        width = schema.count(",") + 1
        return spark.createDataFrame([tuple(r) + (None,) * (width - len(r)) for r in rows], schema)
    return make


@pytest.fixture
def tables(spark, tmp_path):
    """Write named frames as a data folder that queries take."""
    def write(**frames):
        for name, df in frames.items():
            df.write.parquet(str(tmp_path / f"{name}.parquet"))
        return str(tmp_path)
    return write


@pytest.fixture
def prose():
    """Seeded invented prose: a function of (seed, words)."""
    parts = "an er on th re st in en or ti ha ou wh ble ly ing tion".split()

    def make(seed, words):
        r = np.random.default_rng(seed)
        out = []
        for _ in range(words):
            out.append("".join(r.choice(parts, r.integers(1, 5))))
        return " ".join(out)
    return make
