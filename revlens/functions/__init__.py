from revlens.functions.arrays import first_argmax, topic_probabilities
from revlens.functions.formats import alert_level, percent_text, training_day
from revlens.functions.ratings import model_rating, report_rating, sink_rating
from revlens.functions.sentiment import known_prediction, label_of, name_of
from revlens.functions.text import cleaned, combined, length_or_zero

__all__ = [
    "alert_level", "cleaned", "combined", "first_argmax", "known_prediction", "label_of",
    "length_or_zero", "model_rating", "name_of", "percent_text", "report_rating", "sink_rating",
    "topic_probabilities", "training_day",
]
