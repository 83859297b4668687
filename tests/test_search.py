"""The search for the nearest free volunteer."""

import numpy as np
import pandas as pd

from aidmatch.operators import crowds


def test_a_search_compares_few_seats(monkeypatch):
    """Far fewer than there are, also when the near ones are taken."""
    rng, looks, lines = np.random.default_rng(5), [], crowds._Seats._lines
    monkeypatch.setattr(crowds._Seats, "_lines", lambda self, seat, at: looks.append(seat.size) or lines(self, seat, at))

    def spots(many, wide):
        at = pd.DataFrame({"rlat": np.radians(39 + wide * rng.random(many)), "rlon": np.radians(wide * rng.random(many))})
        return at.assign(clat=np.cos(at["rlat"]))

    asked, seats = spots(3000, 0.05).assign(sure=np.inf), spots(12_000, 0.3).assign(radius=rng.choice([2.0, 10.0, 30.0], 12_000))
    picks = crowds.choose(asked, seats)
    assert (picks >= 0).all() and len(set(picks)) == 3000
    assert sum(looks) < 800 * 3000


def test_many_seats_of_one_place(monkeypatch):
    """The earlier of equally near ones wins, though a list does not hold them all."""
    at = pd.DataFrame({"rlat": np.full(500, 0.7), "rlon": np.full(500, 0.1), "clat": np.cos(np.full(500, 0.7))})
    monkeypatch.setattr(crowds, "LIST", 4)
    picks = crowds.choose(at[:400].assign(sure=np.inf), at.assign(radius=1.0))
    assert picks.tolist() == list(range(400))
