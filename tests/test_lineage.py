import pytest

from waymark import lineage


class Context:
    master = "spark://host:7077"

    def getCheckpointDir(self):
        return None


class Session:
    sparkContext = Context()

    class conf:
        @staticmethod
        def get(key, default):
            return default


def test_no_local_folder_on_a_cluster():
    with pytest.raises(ValueError, match=r"spark\.checkpoint\.dir"):
        lineage.shared_folder(Session())
