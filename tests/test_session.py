import pytest

from tidemark import session


class Conf:
    def __init__(self, value):
        self.value = value

    def get(self, name, default):
        return self.value or default


class Fake:
    def __init__(self, value, master):
        self.conf = Conf(value)
        self.sparkContext = type("Context", (), {"master": master, "applicationId": "app-1"})()


def test_scratch_folder():
    assert session.scratch_path(Fake("hdfs:///ck/", "yarn"), "x").startswith("hdfs:///ck/x-")
    local = Fake(None, "local[2]")
    assert session.shared_dir(local) == session.shared_dir(local)
    assert session.scratch_path(local, "x") != session.scratch_path(local, "x")
    with pytest.raises(ValueError):
        session.shared_dir(Fake(None, "spark://host:7077"))
    with pytest.raises(ValueError):
        session.shared_dir(Fake(None, "local-cluster[2,1,1024]"))
