"""Tables in and out: schemas, readers, sinks and the test bed."""
