"""Projections of the shared test tables into the operators' inputs, as SQL for Spark and for DuckDB."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession


class Dialect:
    def __init__(self, sf_dir: str | None):
        """For Spark over a folder of tables; without one, for DuckDB over views."""
        self.dir = sf_dir

    def table(self, name: str) -> str:
        return f"parquet.`{self.dir}/{name}.parquet`" if self.dir else name

    def lines(self, table: str, columns: str) -> str:
        t = self.table(table)
        if self.dir:
            return f"SELECT {columns}, CAST(k AS BIGINT) AS line_no, line FROM {t} LATERAL VIEW posexplode(split(text, '\\n')) x AS k, line"
        return f"SELECT {columns}, CAST(unnest(range(len(string_split(text, chr(10))))) AS BIGINT) AS line_no, unnest(string_split(text, chr(10))) AS line FROM {t}"

    def counted(self, table: str, n: str) -> str:
        """table with k from 0 to n - 1."""
        return f"SELECT *, CAST(k0 AS BIGINT) AS k FROM (SELECT *, explode(sequence(0, CAST({n} AS INT) - 1)) AS k0 FROM {table})" if self.dir else f"SELECT *, CAST(unnest(range({n})) AS BIGINT) AS k FROM {table}"

    def hash(self, condition: str) -> str:
        """62 bits of an embedding; the condition speaks of $0 and $1, a component and the next."""
        at = "embedding[i]", "embedding[i + 1]"
        if not self.dir:
            at = "embedding[i + 1]", "embedding[i + 2]"
        c = condition.replace("$0", at[0]).replace("$1", at[1])
        if self.dir:
            return f"aggregate(transform(sequence(0, 61), i -> IF({c}, shiftleft(1L, i), 0L)), 0L, (a, x) -> a + x)"
        return f"CAST(list_sum(list_transform(range(62), lambda i: CASE WHEN {c} THEN CAST(1 AS BIGINT) << i ELSE 0 END)) AS BIGINT)"

    def two(self, n: str) -> str:
        return f"lpad(concat('', CAST({n} AS BIGINT)), 2, '0')"

    def ctes(self) -> dict[str, str]:
        t = self.table
        return {
            "conv_lines": self.lines("conversations", "conv_id, turn"),
            "numbered": "SELECT CAST(floor(conv_id / 10) AS BIGINT) AS video_id, conv_id, CAST(row_number() OVER (PARTITION BY floor(conv_id / 10) ORDER BY conv_id, turn, line_no) - 1 AS BIGINT) AS seq, line FROM conv_lines",
            "body": """SELECT video_id, seq, seq * 7 + conv_id % 3 AS t, concat(line, CASE seq % 11 WHEN 0 THEN ' please like and subscribe' WHEN 2 THEN ' use the promo code'
                WHEN 4 THEN ' as you can see here' WHEN 5 THEN ' every subscribed client port' WHEN 7 THEN ' moving on' WHEN 9 THEN ' the next part is 1,250 long' WHEN 10 THEN ' [Unclear term: possibly "kernel"]' ELSE '' END) AS text FROM numbered""",
            "other": "SELECT video_id, seq, t, CASE WHEN seq % 5 = 0 THEN concat('zebra ', text) ELSE text END AS text FROM body",
            "raw_lines": f"""SELECT video_id, seq AS pos, concat('[', {self.two("floor(t / 3600)")}, ':', {self.two("floor(t % 3600 / 60)")}, ':', {self.two("t % 60")}, '] ', text) AS line FROM body
                UNION ALL SELECT video_id, last_seq + 1 + k AS pos, concat('[00:00:', {self.two("k * 10")}, '] quoted again') AS line FROM ({self.counted("(SELECT video_id, max(seq) AS last_seq, CAST(5 AS INT) AS five FROM body GROUP BY video_id) last", "five")}) again""",
            "clean_lines": "SELECT video_id, pos, CASE WHEN pos % 9 = 0 THEN concat(line, ' added') WHEN pos % 4 = 0 THEN replace(replace(line, 'see', 'sea'), 'moving', 'mooving') ELSE line END AS line FROM raw_lines",
            "cues": f"""SELECT video_id, seq, concat({self.two("floor(t / 3600)")}, ':', {self.two("floor(t % 3600 / 60)")}, ':', {self.two("t % 60")}) AS hms,
                coalesce(lag(text) OVER (PARTITION BY video_id ORDER BY seq), '') AS prev, text FROM body WHERE text <> ''""",
            "spans": """SELECT video_id, span_no, t AS start, CASE span_no % 4 WHEN 1 THEN t - 10 WHEN 2 THEN t + 400 WHEN 3 THEN t + 2000 ELSE t + 30 END AS stop
                FROM (SELECT video_id, min(t) AS t, CAST(floor(seq / 37) AS BIGINT) AS span_no FROM body GROUP BY video_id, floor(seq / 37)) s""",
            "ends": "SELECT video_id, max(t) AS last_t FROM body GROUP BY video_id",
            "rules": "SELECT CASE WHEN video_id % 2 = 0 THEN 'see' ELSE concat('v', video_id) END AS before, CASE WHEN video_id % 2 = 0 THEN 'sea' ELSE 'w' END AS after FROM ends",
            "doc_lines": self.lines("documents", "doc_id, text"),
            "mixed_lines": "SELECT video_id, pos, line FROM raw_lines UNION ALL SELECT doc_id, line_no, line FROM doc_lines",
            "segments": "SELECT doc_id AS video_id, line_no AS seq, CAST(line_no * 3 AS DOUBLE) AS start, CAST(line_no * 3 + doc_id % 10 AS DOUBLE) AS stop, line AS text FROM doc_lines",
            "vectors": f"SELECT vec_id, CAST(floor(vec_id / 50) AS BIGINT) AS video_id, {self.hash('$0 > 0')} AS p, {self.hash('$1 > $0')} AS d FROM {t('embeddings')}",
            "held": self.counted("(SELECT *, CASE WHEN vec_id % 12 = 0 THEN 6 ELSE 1 + vec_id % 6 END AS hold FROM vectors) v", "hold"),
            "frames": """SELECT h.video_id, idx, idx * 2 AS t, CASE WHEN h.vec_id % 4 = 1 AND k = hold - 1 THEN s.p - s.p % 16777216 WHEN h.vec_id % 4 = 1 AND k = hold - 2 THEN s.p - s.p % 4096 ELSE s.p END AS p, s.d,
                CAST(CASE WHEN h.video_id % 5 = 0 THEN 0.05 + 0.0015 * idx ELSE (0.1 + 0.002 * (h.vec_id % 50) - CASE WHEN h.vec_id % 4 = 1 AND k >= hold - 2 THEN 0.05 ELSE 0 END) * CASE WHEN h.vec_id % 4 = 2 AND hold > 2 AND k = hold - 1 THEN 0.3 ELSE 1 END END AS DOUBLE) AS ink
                FROM (SELECT *, CASE WHEN vec_id % 12 = 0 THEN video_id * 50 ELSE vec_id END AS src, CAST(row_number() OVER (PARTITION BY video_id ORDER BY vec_id, k) - 1 AS BIGINT) AS idx FROM held) h JOIN vectors s ON h.src = s.vec_id""",
            "steps": f"""SELECT user_id AS video_id, idx, CASE WHEN idx = 0 THEN 0 WHEN event_type IN ('view', 'click') THEN v % 5 WHEN event_type = 'signup' THEN 5 + v % 16 WHEN event_type = 'error' THEN v % 60 ELSE 60 + v % 70 END AS nb
                FROM (SELECT user_id, event_type, CAST(floor(value) AS BIGINT) AS v, CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS BIGINT) AS idx FROM {t('events')}) e""",
            "screen": f"SELECT doc_id % 10 AS video_id, doc_id AS frame, concat(text, ' Kernel-Level kernel-level C++17') AS text FROM {t('documents')}",
            "notes": """SELECT doc_id, line_no + 1 AS line_no, CASE line_no % 13 WHEN 1 THEN '# Key takeaways' WHEN 2 THEN '> **External check:** the 4,096 figure' WHEN 3 THEN '> quoted 777 here' WHEN 4 THEN '```' WHEN 5 THEN 'code 12345'
                WHEN 6 THEN '```' WHEN 7 THEN CASE doc_id % 12 WHEN 1 THEN '### What the diagram shows' WHEN 2 THEN 'a webcam view of 640' WHEN 3 THEN 'the video then stops at 64' WHEN 4 THEN 'from the auto-captions of 2,019' WHEN 5 THEN '# How to read these notes'
                WHEN 6 THEN 'in the top left of 12 there is an inset' WHEN 7 THEN 'just as drawn at 17' WHEN 8 THEN 'the colour of the pen' WHEN 9 THEN 'the frame shows 88' ELSE 'he draws a white **rectangle** at 12:34 of 640' END WHEN 8 THEN '| 12:34 | row |' WHEN 9 THEN concat('The lecturer says "', left(line, 60), '" 42 times in v2.5')
                WHEN 10 THEN CASE doc_id % 3 WHEN 0 THEN '## External references' WHEN 1 THEN '## Things worth revisiting' ELSE '## Transcription uncertainties' END
                WHEN 11 THEN '12:34 to 13:00' WHEN 12 THEN '[x](frames/a.png) and [y](missing.md#top) 3,500 items' ELSE concat('The lecturer says "', left(line, 60), '" 250 units') END AS raw FROM doc_lines""",
            "speech": f"SELECT doc_id, concat(CASE WHEN doc_id % 2 = 0 THEN '250 units, forty things. ' ELSE '3,500 items. ' END, CASE WHEN doc_id % 4 < 2 THEN text ELSE '' END) AS text FROM {t('documents')}",
            "artifacts": f"SELECT l_orderkey % 100 AS project, CASE l_returnflag WHEN 'A' THEN 'frames' WHEN 'N' THEN 'transcript' ELSE 'audio' END AS dir, concat(l_orderkey, '-', l_linenumber, '.png') AS file, CAST(floor(l_extendedprice) AS BIGINT) AS bytes FROM {t('lineitem')}",
            "seed": f"SELECT concat('c', s_suppkey - 3) AS channel_id, s_name AS name, s_nationkey AS tier, 'x' AS params, CAST(3 AS BIGINT) AS videos_seen FROM {t('supplier')}",
            "user": f"SELECT concat('c', c_custkey) AS channel_id, c_name AS name, CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE c_nationkey END AS tier, CASE WHEN c_custkey % 2 = 0 THEN '' ELSE c_mktsegment END AS params, CAST(1 AS BIGINT) AS videos_seen FROM {t('customer')}",
            "paths": """SELECT video_id, idx, concat('v', video_id, '/f', lpad(concat('', idx + 1), 6, '0'), '.jpg') AS path, concat(lpad(concat('', CAST(floor(t / 3600) AS BIGINT)), 2, '0'), '-', lpad(concat('', CAST(floor(t % 3600 / 60) AS BIGINT)), 2, '0'), '-', lpad(concat('', t % 60), 2, '0'), '-Slide ', idx, '!.png') AS name, t FROM frames""",
            "pictures": f"SELECT CAST(floor(vec_id / 50) AS BIGINT) AS video_id, vec_id - CAST(floor(vec_id / 50) AS BIGINT) * 50 AS idx, embedding FROM {t('embeddings')}",
            "regions": "SELECT video_id, frame, line_no AS seq, line AS text, CAST(length(line) % 11 / 10.0 AS DOUBLE) AS conf FROM (SELECT doc_id % 10 AS video_id, doc_id AS frame, line_no, line FROM doc_lines) r",
        }

    def needed(self, text: str) -> list[str]:
        """The projections that a text names, with what they need, in order."""
        all_, want = self.ctes(), set()
        todo = [text]
        while todo:
            x = todo.pop()
            for n in all_:
                if n not in want and re.search(rf"\b{n}\b", x):
                    want.add(n)
                    todo.append(all_[n])
        return [n for n in all_ if n in want]

    def sql(self, text: str) -> str:
        own = [f"{n} AS ({self.ctes()[n]})" for n in self.needed(text)]
        head, rest = ("WITH RECURSIVE ", text.removeprefix("RECURSIVE ")) if text.startswith("RECURSIVE ") else ("WITH ", text)
        return head + ", ".join(own) + ((", " + rest.removeprefix("WITH ")) if rest.startswith("WITH ") else " " + rest)


def fixture(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.sql(Dialect(sf_dir).sql(f"SELECT * FROM {name}"))


def duckdb(text: str) -> str:
    return Dialect(None).sql(text)
