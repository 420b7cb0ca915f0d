"""Tables in and out: bars, universes, stored panels, reports and run logs."""
