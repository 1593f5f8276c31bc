import pytest

from contactforge import session


class _Conf:
    def get(self, key, default):
        return default


class _Context:
    def __init__(self, master):
        self.master = master

    def getCheckpointDir(self):
        return None

    def setCheckpointDir(self, folder):
        self.folder = folder


class _Session:
    def __init__(self, master):
        self.conf, self.sparkContext = _Conf(), _Context(master)


@pytest.mark.parametrize("master", ["yarn", "spark://host:7077", "local-cluster[2,1,1024]", "k8s://host"])
def test_no_machine_local_folder_on_a_cluster(master):
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_folder(_Session(master))


def test_local_master_gets_a_temporary_folder():
    local = _Session("local[4]")
    assert session.shared_folder(local) == local.sparkContext.folder
