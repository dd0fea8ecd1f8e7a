"""Writers: idempotent, partition-wise, no data through the driver."""
