from ontime.plans.cleaning import clean_flights, cleaning_job
from ontime.plans.flights import flights
from ontime.plans.modelling import model_job
from ontime.plans.preparation import (
    add_features,
    clean_for_model,
    clean_for_model_audit,
    feature_job,
    read_parts,
    read_trusted,
    write_features,
)
from ontime.plans.sketching import due_sketches, read_sketches, sketch_cleaned

__all__ = [
    "add_features",
    "clean_flights",
    "clean_for_model",
    "clean_for_model_audit",
    "cleaning_job",
    "due_sketches",
    "feature_job",
    "flights",
    "model_job",
    "read_parts",
    "read_sketches",
    "read_trusted",
    "sketch_cleaned",
    "write_features",
]
