"""What an operator's tasks leave in a Python worker: nothing of it stays when another operator's task begins there."""

import pyarrow as pa
import pytest

from strata.llm import decontaminate, quality_rules, secrets, tokens
from strata.llm.common import worker_cache

from .test_operators import text


class Frame:
    """Holds the function that an operator hands to ``mapInArrow``; everything else returns the frame."""

    schema, columns, function = "doc_id long, text string", ["doc_id", "text"], None

    def mapInArrow(self, function, schema):
        self.function = self.function or function
        return self

    def __getattr__(self, name):
        return lambda *a, **k: self


class Phrases:
    def phrases(self):
        return decontaminate.Phrases({}, decontaminate.WINDOW)


def function_of(build):
    frame = Frame()
    build(frame)
    return frame.function


@pytest.mark.parametrize("build", [lambda f: secrets.redact(f, None), lambda f: quality_rules.keep_good(f, None), lambda f: decontaminate._kept(f, Phrases(), 1000)])
def test_a_worker_drops_what_another_operator_keeps(spark, monkeypatch, build):
    for m in (tokens, secrets):
        monkeypatch.setattr(m, "id_text", lambda docs: docs)
    batch = pa.RecordBatch.from_pydict({"doc_id": pa.array([1, 2, 2], pa.int64()), "text": pa.array([text(5, 80), None, ""])})
    pack = function_of(lambda f: tokens.token_pieces(f, 4096))
    first = [b.to_pydict() for b in pack(iter([batch]))]
    kept = worker_cache()["tokenizer:" + tokens.TOKENIZER]
    assert [b.to_pydict() for b in pack(iter([batch, batch]))] == 2 * first and worker_cache()["tokenizer:" + tokens.TOKENIZER] is kept
    out = [b.num_rows for b in function_of(build)(iter([batch]))]
    assert sum(out) <= 3 and not [k for k in worker_cache() if k.startswith("tokenizer")]
    assert [b.to_pydict() for b in pack(iter([batch]))] == first
