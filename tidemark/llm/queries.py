"""The queries of this subpackage and, where SQL can express one, its DuckDB form."""

from tidemark.llm.bpe import op8_byte_bpe
from tidemark.llm.covertree import OP7_SQL, op7_embeddings
from tidemark.llm.ctw import op9_ctw
from tidemark.llm.licenses import OP6_SQL, op6_licenses
from tidemark.llm.media import op1_media
from tidemark.llm.mixing import op2_mixing
from tidemark.llm.simhash import op3_simhash
from tidemark.llm.toxicity import op4_toxicity
from tidemark.llm.urls import OP5_SQL, op5_urls
from tidemark.llm.warc import OP10_SQL, op10_warc

QUERIES = {
    "op1_media": op1_media,
    "op2_mixing": op2_mixing,
    "op3_simhash": op3_simhash,
    "op4_toxicity": op4_toxicity,
    "op5_urls": op5_urls,
    "op6_licenses": op6_licenses,
    "op7_embeddings": op7_embeddings,
    "op8_byte_bpe": op8_byte_bpe,
    "op9_ctw": op9_ctw,
    "op10_warc": op10_warc,
}

ORACLES: dict[str, str] = {
    "op5_urls": OP5_SQL,
    "op6_licenses": OP6_SQL,
    "op7_embeddings": OP7_SQL,
    "op10_warc": OP10_SQL,
}
