"""Order-status transitions judged as they stream in."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from millrace.functions import values as V


class TransitionProcessor(StatefulProcessor):
    """Keeps one entity's status and last applied key."""

    def __init__(self, transitions: Mapping[str, Sequence[str]], initial: str):
        self.transitions = {status: set(targets) for status, targets in transitions.items()}
        self.initial = initial

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("state", "status string, token string")

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues: object) -> Iterator[Row]:
        known = self.state.get()
        status, token = known or (self.initial, None)
        for row in sorted(rows, key=lambda row: (row["position"] is None, row["position"])):
            before, wanted, request = status, row["wanted"], row["token"]
            if wanted == status:
                verdict = "same_state"
            elif wanted not in self.transitions.get(status, ()):
                verdict = "invalid"
            elif request and request == token:
                verdict = "same_key"
            else:
                verdict = "applied"
                status, token = wanted, request
            yield Row(entity=key[0], position=row["position"], current_status=before, verdict=verdict)
        if (status, token) != (known or (self.initial, None)):
            self.state.update((status, token))

    def close(self) -> None:
        pass


def transition_stream(
    stream: DataFrame,
    entity: str,
    status: str,
    position: str,
    token: str,
    transitions: Mapping[str, Sequence[str]] = V.ORDER_TRANSITIONS,
    initial: str = V.INITIAL_STATUS,
) -> DataFrame:
    """Verdict per streamed transition; order within a batch is ``position``.

    Needs the RocksDB state store provider. A micro-batch's rows of one entity
    are judged together, so the trigger's input limit bounds them. They reach Python
    as rows: a pandas frame per entity costs more than judging it. The state is read
    once per entity and batch, and written if it changed.
    """
    shaped = stream.select(
        F.col(entity).cast("string").alias("entity"),
        F.col(position).cast("bigint").alias("position"),
        F.col(status).alias("wanted"),
        F.col(token).cast("string").alias("token"),
    )
    return shaped.groupBy("entity").transformWithState(
        statefulProcessor=TransitionProcessor(transitions, initial),
        outputStructType="entity string, position bigint, current_status string, verdict string",
        outputMode="Append",
        timeMode="None",
    )
