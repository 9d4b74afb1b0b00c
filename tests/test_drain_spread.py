"""The lines of a trigger are decoded by all cores, however few files they lie in."""

from spillway.streaming import drain as D


def test_lines_of_one_file_are_dealt_out(spark, tmp_path, monkeypatch):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.log").write_text("".join(f'{{"entries":[{{"m":{i}}}]}}\n' for i in range(5000)))
    files, plain = [], D.materialise

    def noted(df, name):
        out = plain(df, name)
        files.extend([len(out.inputFiles())] if name == "lines" else [])
        return out

    monkeypatch.setattr(D, "materialise", noted)
    sent = []
    send = lambda rows, epoch: sent.extend((r.batch_start, r.entries) for r in rows.collect())
    bad = lambda rows, epoch: None
    D.drain(spark, str(tmp_path / "in"), str(tmp_path / "cp"), send, bad, batch_size=10).awaitTermination()
    assert files and min(files) > 1
    assert [e for _, entries in sorted(sent) for e in entries] == [f'{{"m":{i}}}' for i in range(5000)]
