import json
import os
from datetime import datetime, timedelta, timezone

BASE = datetime(2026, 6, 6, 10, 0, tzinfo=timezone.utc)


def at(text: str) -> str:
    """``mm:ss`` after 10:00 as wire timestamp."""
    minutes, seconds = text.split(":")
    return (BASE + timedelta(minutes=int(minutes), seconds=float(seconds))).isoformat()


def trade(i, ticker="A", when="00:10", price=100.0, quantity=10, side="buy", **more):
    row = {
        "trade_id": f"t{i}", "ticker": ticker, "price": price, "quantity": quantity, "side": side,
        "trade_type": "market", "bid_price": None, "ask_price": None, "timestamp": when and at(when),
        "exchange": "X", "source": "test",
    }
    return {**row, **more}


def deliver(folder, n, rows):
    """Write one file of payloads; its age orders it after those delivered before."""
    os.makedirs(folder, exist_ok=True)
    path = f"{folder}/{n:04d}.json"
    with open(path + ".tmp", "w") as f:
        f.write("\n".join(r if isinstance(r, str) else json.dumps(r) for r in rows) + "\n")
    os.utime(path + ".tmp", (1_700_000_000 + n, 1_700_000_000 + n))
    os.replace(path + ".tmp", path)


def rows(df, *cols):
    return sorted(tuple(r) for r in (df.select(*cols) if cols else df).collect())
