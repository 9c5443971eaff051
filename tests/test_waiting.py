"""Live queries whose batches take long."""

import pytest

from vigil.plans import queries


def test_a_live_query_may_take_long(monkeypatch):
    class Running:
        isActive = True
        asked = 0

        @property
        def lastProgress(self):
            self.asked += 1
            return {"numInputRows": 0} if self.asked > 9 else None

        def exception(self):
            return "stopped"

    now = [0.0]
    monkeypatch.setattr(queries.time, "time", lambda: now[0])
    monkeypatch.setattr(queries.time, "sleep", lambda s: now.__setitem__(0, now[0] + 100))
    queries._wait_for(Running(), lambda p: p["numInputRows"] == 0)  # its first batch ends after some 900 seconds
    ended = Running()
    ended.isActive = False
    with pytest.raises(RuntimeError, match="did not come so far"):
        queries._wait_for(ended, lambda p: False)
