"""limitlens: batch checks of configured control limits against measured sensor behaviour, on Spark."""
