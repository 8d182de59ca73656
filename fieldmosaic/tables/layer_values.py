"""Map layer names.

Fixed values: the Chinese layer title and its English classification. Crop layers
share one suffix and one prefix, so only the crop is listed.
"""

CROP_SUFFIX = "適栽性等級分布圖"
CROP_PREFIX = "crop_suitability_rating_map"
SOIL_WORD = "土壤"
SOIL_PREFIX = "soil_survey"

FARMLAND = """
農地重要性等級 farmland_importance_level
農地生產力等級 farmland_productivity_levels
"""

CROPS = """
水稻 rice
甘薯 sweet_potato
花生 peanut
大豆 soybean
玉米 corn
小麥 wheat
大麥 barley
高粱 sorghum
粟 millet
紅豆 azuki_bean
綠豆 mung_bean
胡麻 sesame
向日葵 sunflower
油菜 rapeseed
木薯 cassava
甘蔗 sugarcane
茶葉 tea
菸草 tobacco
蠶桑 mulberry
亞麻(甘蔗) flax
苧麻 ramie
黃麻 jute
鐘麻 kenaf
瓊麻 sisal
藺草 rush
香蕉 banana
柑桔 citrus
鳳梨 pineapple
荔枝 lychee
龍眼 longan
番石榴 guava
枇杷 loquat
橄欖 olive
番荔枝 sugar_apple
咖啡 coffee
人心果 sapodilla
澳洲胡桃 macadamia
馬拉巴栗 malabar_chestnut
百香果 passion_fruit
蓮霧 wax_apple
芒果 mango
木瓜 papaya
可可椰子 coconut
檳榔 betel_nut
楊桃 star_fruit
可可 cocoa
酪梨 avocado
介壽果(腰果) cashew
印度棗 indian_jujube
西印度櫻桃 west_indian_cherry
楊梅 chinese_bayberry
李 plum
梅 apricot
桃 peach
梨 pear
蘋果 apple
葡萄 grape
柿 persimmon
栗 chestnut
草莓 strawberry
蘿蔔 radish
"""

# Chinese title, English classification, legend layer that colours it.
SOILS = """
母岩性質 soil_survey_parent_material parent_material_property
土壤石灰性及鹽鹼性 soil_survey_lime_and_salinity soil_calcareousness_and_salinity_alkalinity
土壤特性 soil_survey_soil_properties soil_properties
土壤排水 soil_survey_drainage soil_drainage
土壤型態及形成方式 soil_survey_soil_type_and_formation soil_type_and_formation
土壤酸鹼值 soil_survey_ph soil_ph
土壤質地(0-30公分) soil_survey_texture_0_30cm soil_texture
土壤質地(30-60公分) soil_survey_texture_30_60cm soil_texture
土壤質地(60-90公分) soil_survey_texture_60_90cm soil_texture
土壤質地(90-150公分) soil_survey_texture_90_150cm soil_texture
土壤坡度 soil_survey_slope soil_slope
"""


def layer_rows() -> list[tuple[str, str, str]]:
    """(name_zh, name_en, legend layer) of every known map layer, in order."""
    rows = []
    for line in FARMLAND.strip().splitlines():
        title, english = line.split(" ")
        rows.append((title, english, english))
    for line in CROPS.strip().splitlines():
        crop, english = line.split(" ")
        rows.append((crop + CROP_SUFFIX, f"{CROP_PREFIX}_{english}", CROP_PREFIX))
    for line in SOILS.strip().splitlines():
        title, english, legend = line.split(" ")
        rows.append((title, english, legend))
    return rows
