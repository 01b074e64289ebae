"""Tasks of the training-data operators run in workers that cannot import this package."""

import subprocess
import sys
from pathlib import Path

SCRIPT = """
import sys
sys.path.insert(0, {root!r})
from tapelake.session import local_session
from tapelake.llm import copies, descent, runs, trie, webtext, wordpiece
spark = local_session("shipping", cores=2, shuffle_partitions=2)
docs = spark.createDataFrame([(1, "a b c d e f g"), (2, "a a a a a a a a"), (3, "a b c d e f h")], "doc_id long, text string")
print("tokens", wordpiece.token_counts(docs).count())
print("runs", runs.periodic_runs(docs).filter("n_runs = 1").count())
page = "<html><body><div><p>one two</p></div></body></html>"
print("pages", webtext.main_text(spark.createDataFrame([(1, "http://a/b", page)], "page_id long, url string, html string")).collect()[0].n_chars)
vectors = [(k, [1.0, 0.001 * k], 1) for k in range(5)]
print("links", descent.near_copies(spark.createDataFrame(vectors, "vec_id long, embedding array<float>, label int")).collect()[0].n_links)
turns = spark.createDataFrame([(1, 0, "u", "x y"), (2, 0, "u", "x y")], "conv_id long, turn long, role string, text string")
print("trie", trie.prefix_trie(trie.numbered(turns)).count())
"""


def test_workers_without_the_package(tmp_path):
    root = str(Path(__file__).resolve().parent.parent.parent)
    script = tmp_path / "run.py"
    script.write_text(SCRIPT.format(root=root))
    done = subprocess.run([sys.executable, str(script)], cwd=tmp_path, capture_output=True, text=True, timeout=400)
    assert done.returncode == 0, done.stderr[-2000:]
    for line in ("tokens 3", "runs 1", "pages 7", "links 4", "trie 2"):
        assert line in done.stdout
