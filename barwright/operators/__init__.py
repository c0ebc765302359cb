"""DataFrame -> DataFrame operators over ticks, bars and features."""
