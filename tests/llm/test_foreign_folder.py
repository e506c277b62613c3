"""All text operators where the executors have no copy of the package: started from another folder, its path known to
the driver alone."""

import os
import subprocess
import sys
import textwrap

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SCRIPT = """
    import sys
    sys.path.insert(0, {root!r})
    from pyspark.sql import functions as F
    from fieldkit.session import get_spark
    from fieldkit.llm import queries
    import corpus_pipeline
    spark = get_spark(master="local[4]", shuffle_partitions=4)
    sf = "/root/testdata/sf0.001"

    def there(batches):
        import importlib.util
        for b in batches:
            yield b.assign(found=importlib.util.find_spec("fieldkit") is not None)
    assert not spark.range(1).mapInPandas(there, "id long, found boolean").first().found
    for name, query in sorted(queries.queries().items()) + [("pipeline", corpus_pipeline.run)]:
        n = query(spark, sf).count()
        assert n > 0, name
        print(name, n, flush=True)
"""


def test_all_queries_without_a_copy_on_the_executors(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", textwrap.dedent(SCRIPT.format(root=ROOT))], cwd=tmp_path, env=env, capture_output=True,
                          text=True, timeout=600)
    assert done.returncode == 0, done.stdout[-1000:] + done.stderr[-3000:]
    assert len(done.stdout.splitlines()) == 14
