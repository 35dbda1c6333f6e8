"""Readers and writers: feed decoding, files, Kafka, replay, sinks."""
