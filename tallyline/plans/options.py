"""Settings of the streaming job."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class JobOptions:
    # Topic and group names and intervals the message producers and consumers expect.
    kafka_servers: str = "localhost:9092"
    source_topic: str = "order-final-state"
    sink_topic: str = "indicator-slice-updates"
    consumer_group: str = "indicator-accumulation"
    dead_letter_topic: str = "order-final-state-dlq"
    #: Topic for orders whose script failed; None reports none.
    reject_topic: str | None = None
    checkpoint_interval_ms: int = 60_000
    source_parallelism: int = 1
    starting_offsets: str = "earliest"
    definitions_refresh_ms: int = 30_000

    #: Upper bound on records per micro-batch; None takes all that is there.
    max_records_per_trigger: int | None = None
    #: ``first_arrival``: the earliest delivery counts, also within one micro-batch.
    #: ``any``: any one delivery of a micro-batch counts; smallest state, append output.
    dedupe: str = "first_arrival"
    #: Forget an order this long after its event time (``any`` only).  None keeps it for ever.
    #: An order that comes again after that counts again, and one that comes later than that is lost.
    forget_after: str | None = None

    def __post_init__(self) -> None:
        if self.dedupe not in ("first_arrival", "any"):
            raise ValueError(f"unknown dedupe mode: {self.dedupe}")
        if self.forget_after and self.dedupe != "any":
            raise ValueError("forget_after needs dedupe='any'")

    @property
    def first_offsets(self) -> str:
        """Where a query without checkpoint starts: the end if asked for, else the beginning."""
        return "latest" if self.starting_offsets.lower() == "latest" else "earliest"
