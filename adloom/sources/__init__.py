"""Readers and writers. Formats are parameters: a connector on the class path
(jdbc, kafka, document and wide-row stores) is used by naming it."""
