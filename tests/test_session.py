"""A machine-local checkpoint folder is picked in local mode only."""

from types import SimpleNamespace as Stub

import pytest

from riskfeat.session import CHECKPOINT_CONF, ensure_checkpoint_dir


def _session(master, configured=None):
    set_to, conf = [], {CHECKPOINT_CONF: configured} if configured else {}
    sc = Stub(master=master, getCheckpointDir=lambda: set_to[0] if set_to else None, setCheckpointDir=set_to.append,
              getConf=lambda: Stub(get=lambda k, d=None: d))
    return Stub(sparkContext=sc, conf=Stub(get=lambda k, d=None: conf.get(k, d), set=conf.__setitem__))


@pytest.mark.parametrize("master", ["yarn", "spark://host:7077", "local-cluster[3,2,1024]", "k8s://https://host"])
def test_a_cluster_names_its_folder(master):
    with pytest.raises(RuntimeError, match=CHECKPOINT_CONF):
        ensure_checkpoint_dir(_session(master))
    assert ensure_checkpoint_dir(_session(master, "/shared/x")) == "/shared/x"


@pytest.mark.parametrize("master", ["local", "local[8]", "local[*]"])
def test_local_mode_picks_one(master, tmp_path, monkeypatch):
    monkeypatch.setenv("TMPDIR", str(tmp_path))
    assert ensure_checkpoint_dir(_session(master)).startswith(str(tmp_path))
