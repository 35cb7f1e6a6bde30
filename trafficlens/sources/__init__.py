"""Readers of report inputs."""
