"""Marquee: catalogue loading, message-queue state and catalogue analytics as Spark jobs."""
