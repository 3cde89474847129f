"""What an episode on a live stream costs: calls to its state, and frames that it hands on."""

import pandas as pd

from strandflow.streaming import live

DAY = 86_400_000_000


class Kept:
    """State and clock of one episode, which count what is asked of them."""

    def __init__(self, ms=0):
        self.value, self.reads, self.timers, self.ms = None, 0, [], ms

    getValueState = getListState = lambda self, name, schema: Kept()
    registerTimer = lambda self, at: self.timers.append(at)
    getCurrentWatermarkInMs = lambda self: self.ms
    appendList = lambda self, rows: setattr(self, "value", (self.value or []) + rows)
    put = update = lambda self, value: setattr(self, "value", value)
    clear = lambda self: setattr(self, "value", None)

    def exists(self):
        self.reads += 1
        return self.value is not None

    def get(self):
        return self.value


def test_rows_before_any_watermark_only_wait_and_an_episode_ends_in_one_frame():
    made, handle = live.Resampler(["q_0"], 2 * DAY, 10 * DAY, DAY), Kept()
    made.init(handle)
    rows = pd.DataFrame({"t_us": [DAY, 2 * DAY, 3 * DAY], "rate": [4.0] * 3, "q_0": [0.0, 1.0, 2.0]})
    assert list(made.handleInputRows(("s", "e"), iter([rows]), Kept())) == []
    assert made.waiting.reads == made.progress.reads == 0 and handle.timers == [3 * DAY // 1000]
    (frame,) = made.handleExpiredTimer(("s", "e"), Kept(5 * DAY // 1000), None)
    assert handle.timers[1:] == [13 * DAY // 1000] and frame["step"].tolist() == list(range(8))
    (frame,) = made.handleExpiredTimer(("s", "e"), Kept(20 * DAY // 1000), None)
    assert frame["n_raw"].tolist()[-1] == 3 and made.progress.value is None and made.waiting.value is None


def test_a_group_of_episodes_costs_the_calls_of_one():
    made, handle = live.Resampler(["q_0"], 2 * DAY, 10 * DAY, DAY), Kept()
    made.init(handle)
    names = {"session_id": [f"s{i}" for i in range(500) for _ in range(3)], "episode_id": "e"}
    rows = pd.DataFrame(names | {"t_us": [DAY, 2 * DAY, 3 * DAY] * 500, "rate": 4.0, "q_0": [0.0, 1.0, 2.0] * 500})
    assert list(made.handleInputRows((7,), iter([rows[:700], rows[700:]]), Kept())) == []
    assert len(made.waiting.value) == 2 and handle.timers == [3 * DAY // 1000]  # a value for each frame, not for each row
    (frame,) = made.handleExpiredTimer((7,), Kept(2 * DAY // 1000), None)  # some samples still wait
    (rest,) = made.handleExpiredTimer((7,), Kept(20 * DAY // 1000), None)
    told = pd.concat([x.dropna(axis=1, how="all") for x in (frame, rest)])
    points, ends = told[told["step"].notna()], told[told["step"].isna()]
    assert points.groupby("session_id")["q_0"].apply(list).tolist() == [[k / 4 for k in range(9)]] * 500
    assert ends["session_id"].nunique() == 500 and (ends["n_raw"] == 3).all() and (ends["n_steps"] == 9).all()
    assert made.waiting.reads + made.progress.reads <= 6 and len(handle.timers) == 2
    assert made.progress.value is None and made.waiting.value is None


def test_an_episode_is_looked_at_when_its_newest_sample_is_passed():
    made, handle = live.Resampler(["q_0"], 2 * DAY, 10 * DAY, DAY), Kept()
    made.init(handle)
    rows = pd.DataFrame({"session_id": ["a", "a", "b"], "episode_id": "e", "t_us": [DAY, 2 * DAY, 5 * DAY], "rate": 4.0, "q_0": 0.0})
    list(made.handleInputRows((7,), iter([rows]), Kept()))
    list(made.handleExpiredTimer((7,), Kept(2 * DAY // 1000), None))
    list(made.handleExpiredTimer((7,), Kept(5 * DAY // 1000), None))
    list(made.handleExpiredTimer((7,), Kept(12 * DAY // 1000), None))
    assert handle.timers == [x * DAY // 1000 for x in (2, 5, 12, 15)]
