"""Sources and sinks: driver tables and the trip view, trip files and landing,
cleaned / star / warehouse writers."""
