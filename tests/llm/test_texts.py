import pyarrow as pa

from msgmart.llm import texts


def test_workers_let_go_after_each_task(monkeypatch):
    steps = []
    monkeypatch.setattr(texts, "only_of_this_stage", lambda: steps.append("begin"))
    monkeypatch.setattr(texts, "let_go", lambda: steps.append("end"))

    @texts.tidy
    def run(batches):
        """What it does."""
        for batch in batches:
            steps.append(batch.num_rows)
            yield batch

    batch = pa.RecordBatch.from_arrays([pa.array(range(1201))], names=["x"])
    got = list(run(texts.few(iter([batch, batch.slice(0, 0), batch.slice(0, 3)]))))
    assert steps == ["begin", 500, 500, 201, 3, "end"] and run.__doc__ == "What it does."
    assert [x for part in got for x in part.column(0).to_pylist()] == [*range(1201), 0, 1, 2]
