"""Default label sets and texts.

Fixed values: readers of the gold tables filter on these strings, so they must stay as they are. Every
operator takes its labels as an argument; these are only the defaults.
"""

from __future__ import annotations

from .buckets import Quadrants

MOOD = Quadrants("Happy_Energetic", "Happy_Calm", "Sad_Energetic", "Sad_Calm", "Neutral")
MOOD_CODE = Quadrants(0, 1, 2, 3, 4)
MOOD_STATE = Quadrants(
    "Happy & Energetic", "Happy & Calm", "Intense & Focused", "Reflective & Calm", "Neutral"
)
CLUSTER_NAME = Quadrants(
    "Energetic Joy", "Peaceful Contentment", "Intense Focus", "Melancholic Reflection", "Balanced Neutral"
)
SEQUENCE_STATE = Quadrants(
    "High_Energy_Positive", "Low_Energy_Positive", "High_Energy_Negative", "Low_Energy_Negative", "Neutral"
)
ARCHETYPE = Quadrants(
    "Energetic Optimist", "Peaceful Relaxer", "Intense Focuser", "Contemplative Thinker", "Balanced Explorer"
)

STATE_ACTIVITY = {
    "Happy & Energetic": "Exercise, social activities, upbeat playlists",
    "Happy & Calm": "Relaxation, acoustic music, mindfulness",
    "Intense & Focused": "Deep work, instrumental music, concentration",
    "Reflective & Calm": "Journaling, ambient music, meditation",
}
STATE_ACTIVITY_DEFAULT = "General listening, explore new music"
STATE_TIP = {
    "Happy & Energetic": "Great time for physical activity and social connection",
    "Happy & Calm": "Perfect for self-care and peaceful activities",
    "Intense & Focused": "Ideal for productivity and focused work",
    "Reflective & Calm": "Good for introspection and quiet contemplation",
}
STATE_TIP_DEFAULT = "Balance your mood with varied activities"

CLUSTER_TEXT = {
    "Energetic Joy": "High positivity with energetic, upbeat music",
    "Peaceful Contentment": "Positive mood with calm, relaxing music",
    "Intense Focus": "Low valence but high energy - concentrated work mode",
    "Melancholic Reflection": "Low energy and valence - introspective listening",
}
CLUSTER_TEXT_DEFAULT = "Balanced emotional state with varied music"

SEVERITY = ("High", "Medium", "Low")
SEVERITY_TEXT = {
    "High": "Unusual listening pattern - significant deviation from normal behavior",
    "Medium": "Moderate deviation - possible mood shift or special occasion",
}
SEVERITY_TEXT_DEFAULT = "Minor variation within acceptable range"

SEQUENCE_TYPE = {"Positive": "Positive Mood Sequence", "Negative": "Negative Mood Sequence"}
SEQUENCE_TYPE_DEFAULT = "Neutral Sequence"
SEQUENCE_INSIGHT = {
    "High_Energy_Positive": "Sustained positive energy - active engagement",
    "Low_Energy_Positive": "Relaxed contentment - passive enjoyment",
    "High_Energy_Negative": "Intense focus or stress - may need mood intervention",
    "Low_Energy_Negative": "Reflective or sad - monitor for prolonged periods",
}
SEQUENCE_INSIGHT_DEFAULT = "Varied emotional states - healthy balance"

ARCHETYPE_TEXT = {
    "Energetic Optimist": "Prefers upbeat, energetic music. Listening supports active lifestyle.",
    "Peaceful Relaxer": "Gravitates toward calm, positive music. Music for relaxation and comfort.",
    "Intense Focuser": "High-energy, low-valence tracks. Music for concentration and productivity.",
    "Contemplative Thinker": "Low-energy, introspective music. Reflective and thoughtful listening.",
}
ARCHETYPE_TEXT_DEFAULT = "Varied musical taste. Adapts music to different moods and contexts."
WELLBEING_VARIABLE = "High mood variability detected - ensure balanced emotional wellbeing"
WELLBEING_LOW = "Lower average mood - consider incorporating more uplifting music"
WELLBEING_DEFAULT = "Healthy listening patterns - continue current approach"

REASON_ENERGY = "High energy track to boost mood"
REASON_DANCE = "Danceable track to improve mood"
REASON_DEFAULT = "Positive track to enhance wellbeing"
TARGET_SCENARIO = "When feeling down or low energy"

PRIORITY = ("High Priority", "Medium Priority", "Low Priority")
INTERVENTION_TEXT = {
    "High Priority": "Consider mood-boosting activities, reach out to support network",
    "Medium Priority": "Listen to uplifting music, engage in light physical activity",
}
INTERVENTION_TEXT_DEFAULT = "Continue normal listening patterns"
SUPPORT_PLAYLIST = "Energy Boost, Mood Lift"
SUPPORT_PLAYLIST_DEFAULT = "Personalized Mix"

STRENGTH = ("Strong", "Moderate", "Weak")
SHIFT = ("Stable", "Major_Shift", "Minor_Shift")
PERIOD = ("Weekend", "Weekday")
STABILITY = ("stable", "moderate", "unstable")
