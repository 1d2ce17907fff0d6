"""Calls to outside services, a pluggable function from text to text, as a column.

A call that fails gives an error in its row.  Without a provider a stub answers from the words of the text alone.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from urllib.error import HTTPError, URLError
from urllib.request import Request, urlopen

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Words the stub goes by.
SOCIAL_WORDS = ("labour", "work", "state", "justice", "poor", "people", "nation")
SPIRITUAL_WORDS = ("prayer", "faith", "spirit", "soul", "grace", "church")

#: Bytes of text that a task of calls gets; what is more waits for a later round.
TASK_BYTES = 64 << 20


def stub_theme(text: str) -> str:
    """A theme report from counts of words: the same for the same text, and no more than that."""
    words = text.lower().split()
    social, spiritual = (sum(words.count(w) for w in group) for group in (SOCIAL_WORDS, SPIRITUAL_WORDS))
    theme = "Social" if social > spiritual else "Spiritual" if spiritual > social else "Mixed"
    first = " ".join(words[:12])
    return f"---\npass: stub\n---\n\n- **Key theme:** {theme}\n- **Theme (one sentence):** {first}\n- **Summary:** {len(words)} words\n"


def stub_gradient(text: str) -> str:
    """A research report with a block of gradients from counts of words: the same for the same text, and no more than that."""
    words = text.lower().split()
    n = max(1, len(words))
    social, spiritual = (sum(words.count(w) for w in group) / n for group in (SOCIAL_WORDS, SPIRITUAL_WORDS))
    axis = lambda a, b: f'{{"saturation": {round(a, 4)}, "density": {round(b, 4)}}}'
    return f'# Report\n\n## Gradients\n\n```json\n{{"reflective": {axis(social, spiritual)}, "prospective": {axis(spiritual, social)}}}\n```\n'


class HttpProvider:
    """A service behind an address: the text goes out as JSON, the answer is read from a field of the JSON that comes back.

    ``body``: what is sent, with the text in place of every ``None`` in it; ``field``: where the answer stands, keys and places
    with dots between.  An answer that is late, and one that says to come back (408, 425, 429 and 5xx), is asked for again
    after a growing pause, or the one it names, ``tries`` times in all; anything else is the row's error at once.
    """

    def __init__(self, url: str, field: str = "text", body: dict | None = None, headers: dict[str, str] | None = None, timeout: float = 120.0, tries: int = 3, pause: float = 1.0) -> None:
        self.url, self.field, self.body, self.headers = url, field, {"text": None} if body is None else body, headers or {}
        self.timeout, self.tries, self.pause = timeout, tries, pause

    def _filled(self, value, text: str):
        if value is None:
            return text
        if isinstance(value, dict):
            return {k: self._filled(v, text) for k, v in value.items()}
        return [self._filled(v, text) for v in value] if isinstance(value, list) else value

    def _ask(self, data: bytes) -> dict:
        request = Request(self.url, data, {"Content-Type": "application/json", **self.headers})
        with urlopen(request, timeout=self.timeout) as r:  # noqa: S310
            return json.loads(r.read())

    def __call__(self, text: str) -> str:
        data = json.dumps(self._filled(self.body, text)).encode()
        for n in range(1, self.tries + 1):
            wait = self.pause * 2 ** (n - 1)
            try:
                found = self._ask(data)
                for key in self.field.split("."):
                    found = found[int(key)] if isinstance(found, list) else found[key]
                if not isinstance(found, str):
                    raise ValueError(f"no text in {self.field}")
                return found
            except HTTPError as e:
                if n == self.tries or not (e.code in (408, 425, 429) or e.code >= 500):
                    raise
                named = e.headers.get("Retry-After") or ""
                wait = float(named) if named.isdigit() else wait
            except (URLError, TimeoutError):
                if n == self.tries:
                    raise
            except (KeyError, IndexError):
                raise ValueError(f"no {self.field} in the answer") from None
            time.sleep(wait)
        raise AssertionError("unreachable")


def research(df: DataFrame, text_col: str, key: str, providers: dict[str, Callable[[str], str]], concurrency: int = 5) -> DataFrame:
    """``tier, key, report, error``: every tier's provider on every row, tiers in the order given.

    A tier is written down before the next one begins, so the bound on calls holds for all of them together.
    """
    from corpusloom.sources.files import settle

    out = None
    for tier, provider in providers.items():
        own = settle(call(df, text_col, key, provider, concurrency).select(F.lit(tier).alias("tier"), key, "report", "error"))
        out = own if out is None else out.unionByName(own)
    return out


def call(df: DataFrame, text_col: str, key: str, provider: Callable[[str], str] = stub_theme, concurrency: int = 5, tasks: int | None = None) -> DataFrame:
    """``key, report, error``; at most ``concurrency`` calls run at once in the whole job.  A null text is not sent.

    Rows are dealt to ``tasks`` partitions (as many as can run side by side, unless given, and no more than calls); the
    calls are shared out among these, so the bound holds wherever and whenever they run.  Texts of over :data:`TASK_BYTES` a
    task are called for in rounds, at once and one after the other, each written down before the next begins: so no task
    grows with the texts.  A task that is lost and run again calls again for its rows.  Texts are measured first: write
    ``df`` down if it is dear.
    """
    spark = df.sparkSession
    if concurrency < 1:
        raise ValueError("no calls at all")
    tasks = max(1, min(concurrency, spark.sparkContext.defaultParallelism if tasks is None else tasks))

    def one(text):
        if text is None:
            return None, "no text"
        try:
            return provider(text), None
        except Exception as e:  # whatever a service raises is that row's error
            return None, str(e) or type(e).__name__

    def run(batches):
        from pyspark import TaskContext

        share = concurrency // tasks + (TaskContext.get().partitionId() < concurrency % tasks)
        with ThreadPoolExecutor(share) as pool:
            for b in batches:
                for lo in range(0, b.num_rows, 256):
                    part = b.slice(lo, 256)
                    rows = list(pool.map(one, part.column(1).to_pylist()))
                    yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array(c, pa.string()) for c in zip(*rows, strict=True))], names=[key, "report", "error"])

    kind = df.schema[key].dataType.simpleString()

    def answers(rows: DataFrame) -> DataFrame:
        # The last step before the calls: partitions are numbered as they were dealt.
        return rows.repartition(tasks).mapInArrow(run, f"`{key}` {kind}, report string, error string")

    texts = df.select(F.col(key), F.col(text_col).cast("string").alias("_text"))
    rounds = -(-(texts.agg(F.sum(F.octet_length("_text"))).first()[0] or 0) // (tasks * TASK_BYTES))
    return answers(texts) if rounds <= 1 else _in_rounds(texts, answers, rounds, tasks)


def _in_rounds(texts: DataFrame, answers: Callable[[DataFrame], DataFrame], rounds: int, tasks: int) -> DataFrame:
    """Texts dealt evenly to files, and the answers to as many of these at a time as there are tasks."""
    from corpusloom.sources.files import scratch

    spark, path = texts.sparkSession, f"{scratch(texts.sparkSession)}/calls-{uuid.uuid4().hex}"
    texts.repartition(rounds * tasks).write.parquet(f"{path}/texts")
    dealt = sorted(spark.read.parquet(f"{path}/texts").inputFiles())
    for lo in range(0, len(dealt), tasks):
        answers(spark.read.schema(texts.schema).parquet(*dealt[lo : lo + tasks])).write.mode("append").parquet(f"{path}/answers")
    return spark.read.parquet(f"{path}/answers")
