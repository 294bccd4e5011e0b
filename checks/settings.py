"""Settings the test tables need: their dates and amounts differ from the defaults' world."""

from __future__ import annotations

from tagloom import labels as L
from tagloom.labels import Bin, scaled
from tagloom.plans.profile import ProfileSettings

ID_DIGITS = 9
AS_OF_LOGIN = "2024-01-31"
AS_OF_ORDERS = "2001-08-02"

RECENCY = [Bin(5, ge=30, lt=120), Bin(4, ge=120, lt=210), Bin(3, ge=210, lt=300), Bin(2, ge=300, lt=480), Bin(1, ge=480)]
FREQUENCY = [Bin(5, ge=20), Bin(4, ge=15, lt=20), Bin(3, ge=10, lt=15), Bin(2, ge=5, lt=10), Bin(1, ge=1, lt=5)]
MONEY = scaled(L.RFM_MONEY, 10)

LADDERS = {
    "spend_total": scaled(L.SPEND_TOTAL, 5),
    "spend_max": scaled(L.SPEND_MAX, 9),
    "spend_avg": scaled(L.SPEND_AVG, 80),
    "purchase_frequency": [Bin("高", ge=15), Bin("中", ge=8, lt=15), Bin("低", ge=0, lt=8)],
    "consumption_cycle": scaled(L.CONSUMPTION_CYCLE, 2),
}

PROFILE = ProfileSettings(as_of=AS_OF_LOGIN, id_digits=ID_DIGITS, ladders=LADDERS)
