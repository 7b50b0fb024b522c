"""The composed jobs: archive to import files, classification, validation."""
